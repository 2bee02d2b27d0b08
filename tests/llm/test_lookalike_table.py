"""The look-alike table is whole or there is none."""

from types import SimpleNamespace as Names

import pytest
from py4j.java_gateway import JavaPackage

from glossweave.llm import lookalike


def test_no_table_without_icu():
    text = Names(SpoofChecker=JavaPackage("com.ibm.icu.text.SpoofChecker", None))
    with pytest.raises(RuntimeError, match="ICU"):
        lookalike._prototypes(Names(_jvm=Names(com=Names(ibm=Names(icu=Names(text=text))))))
