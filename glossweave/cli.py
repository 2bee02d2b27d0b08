"""Command line: python -m glossweave.cli COMMAND ..."""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

from glossweave import __version__


def elapsed(seconds: float) -> str:
    """``12.3s`` below a minute, else ``2m 5s``."""
    return f"{seconds:.1f}s" if seconds < 60 else f"{int(seconds // 60)}m {int(seconds % 60)}s"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="glossweave")
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="command", required=True)
    e = sub.add_parser("export", help="sheet or database to concept documents", aliases=["xlsx2yaml", "db2yaml"])
    e.add_argument("file")
    e.add_argument("-o", "--output", default=".")
    e.add_argument("--areas", required=True, help="YAML file of subject areas")
    e.add_argument("--only-concepts", help="LIKE pattern of codes")
    e.add_argument("--only-languages", help="comma-separated languages")
    e.add_argument("--no-areas", action="store_true", help="leave the area and section concepts out")
    e.add_argument("--strict", action="store_true", help="stop at the first row that can't be exported")
    e.add_argument("--packed", action="store_true", help="documents as datasets of names and bodies instead of a file each")
    e.add_argument("--explain", action="store_true", help="print the plan of the concepts")
    d = sub.add_parser("xlsx2db", help="sheet to a SQLite file")
    d.add_argument("file")
    d.add_argument("-o", "--output", required=True)
    r = sub.add_parser("reparse", help="stored pages to documents")
    r.add_argument("folder")
    r.add_argument("-o", "--output", required=True)
    a = sub.add_parser("subject-areas", help="the hierarchy as YAML")
    a.add_argument("areas")
    a.add_argument("-o", "--output")
    f = sub.add_parser("fetch", help="one stored concept on standard output")
    f.add_argument("folder")
    f.add_argument("code")
    c = sub.add_parser("reconcile", help="termbase file and page folder to reports")
    c.add_argument("termbase")
    c.add_argument("pages")
    c.add_argument("-o", "--output", required=True)
    c.add_argument("--detected-at", default=time.strftime("%Y-%m-%d"))
    c.add_argument("--packed", action="store_true", help="documents and changes as datasets instead of a file each")
    return p


def page_side(pages):
    """Pages as a side of a reconciliation: terms and definitions per language, notes and examples taken from the definition's lines."""
    from pyspark.sql import functions as F

    from glossweave.functions.text import note_and_example_lines
    from glossweave.sources.snapshots import parsed_pages

    each = parsed_pages(pages).where("parsed").select("code", F.posexplode("entries").alias("_ord", "_e"))
    parts = note_and_example_lines(F.col("_e.definition"))
    return each.select(
        "code", F.col("_e.language").alias("language"), "_ord", F.lit("valid").alias("status"), F.col("_e.terms").alias("designations"),
        parts["definition"].alias("definition"), parts["notes"].alias("notes"), parts["examples"].alias("examples"),
    )


def termbase_side(rows):
    """Termbase rows as a side, with the designations that are left of their terms without markers."""
    from pyspark.sql import functions as F

    from glossweave.functions.labels import termbase_status
    from glossweave.sources.snapshots import merged_terms

    term = F.struct("term_no", "designation")
    terms = merged_terms(rows).groupBy("code", "language", "_ord").agg(F.array_sort(F.collect_list(term)).alias("_terms"))
    named = rows.join(terms, ["code", "language", "_ord"], "left")
    return named.select(
        "code", "language", F.col("lang_no").alias("_ord"), termbase_status(F.col("entry_status")).alias("status"),
        F.coalesce("_terms.designation", F.array().cast("array<string>")).alias("designations"), F.nullif("definition", F.lit("")).alias("definition"), "notes", "examples",
    )


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from glossweave.session import local_session
    from glossweave.sinks import files
    from glossweave.sources import dimensions, dispatch, snapshots

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    began = time.monotonic()
    if args.command in ("export", "xlsx2yaml", "db2yaml"):
        from glossweave.functions.labels import language_dimension
        from glossweave.operators.export import export

        try:
            sheet = dispatch.load_sheet(spark, args.file)
        except ValueError as x:
            print(x, file=sys.stderr)
            return 1
        made = export(sheet, dimensions.subject_areas(spark, args.areas), language_dimension(spark), only_concepts=args.only_concepts, only_languages=args.only_languages, include_areas=not args.no_areas, strict=args.strict)
        if args.explain:
            from glossweave.session import plan_text

            print(plan_text(made.concepts))
        Path(args.output).mkdir(parents=True, exist_ok=True)
        files.write_concepts(made.concepts, args.output, args.packed)
        files.write_documents(made.hierarchy.withColumns({"_n": made.hierarchy["concept_id"]}).selectExpr("concat('concept-', concept_id, '.yaml') AS name", "struct(concept_id, kind, domains, tags, term, language, domain, related) AS value"), "name", "value", f"{args.output}/{'areas' if args.packed else 'concepts'}", args.packed)
        files.write_figures(made.figures, args.output, args.packed)
        works = files.write_list(made.bibliography, f"{args.output}/bibliography.yaml")
        files.write_register(made.register, f"{args.output}/register.yaml")
        numbers = made.stats.first()
        aside = made.quarantine.groupBy("error").count().orderBy("error").collect()  # one row per kind of error
        for row in aside:
            print(f"{row['count']} rows set aside: {row.error}", file=sys.stderr)
        print(f"{numbers.concept_count} concepts, {numbers.localized_count} localizations, {numbers.figure_count} figures, {works} works, {elapsed(time.monotonic() - began)}")
    elif args.command == "xlsx2db":
        print(files.write_sqlite(dispatch.load_sheet(spark, args.file), args.output), "rows")
    elif args.command == "reparse":
        rows = snapshots.parsed_pages(snapshots.read_pages(spark, f"{args.folder}/pages")).where("parsed")
        files.write_documents(rows.selectExpr("concat('concept-', code, '.yaml') AS name", "struct(code, entries) AS value"), "name", "value", args.output)
    elif args.command == "subject-areas":
        from glossweave.operators.hierarchy import section_tree

        tree = section_tree(dimensions.subject_areas(spark, args.areas))
        if args.output:
            files.write_list(tree, args.output)
        else:
            for row in tree.toLocalIterator():
                print(files.dump([files.compact(row.asDict(recursive=True))]), end="")
    elif args.command == "fetch":
        from pyspark.sql import functions as F

        rows = snapshots.read_concepts(spark, args.folder).where(F.col("code") == F.lit(args.code)).collect()
        if not rows:
            print(f"no concept {args.code}", file=sys.stderr)
            return 1
        for row in rows:
            print("---\n" + files.dump(files.compact(row.asDict(recursive=True))), end="")
    elif args.command == "reconcile":
        from glossweave.operators.reconcile import change_rows, reconcile
        from glossweave.session import cut_lineage

        termbase = snapshots.read_termbase(spark, args.termbase)
        old, new = termbase_side(termbase), page_side(snapshots.read_pages(spark, args.pages))
        # every report reads it: made once
        both = cut_lineage(reconcile(old, new, args.detected_at, snapshots.concept_dates(termbase)))
        Path(args.output).mkdir(parents=True, exist_ok=True)
        files.write_documents(both.where("size(localized) > 0").selectExpr("concat(code, '.yaml') AS name", "struct(code, status, dates, localized) AS value"), "name", "value", f"{args.output}/concepts", args.packed)
        files.write_reports(both, change_rows(both, args.detected_at), args.output, single_file=not args.packed)
        print(elapsed(time.monotonic() - began))
    return 0


if __name__ == "__main__":
    sys.exit(main())
