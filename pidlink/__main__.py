"""Command line for the jobs (submit with spark-submit or run locally).

    python -m pidlink mapping --meta META.zip --works WORKS_DIR --sources SOURCES_DIR --out OUT
    python -m pidlink categorise --multi-mapped DIR --works WORKS_DIR --sources SOURCES_DIR --out OUT
    python -m pidlink analysis --multi-mapped DIR --works WORKS_DIR --sources SOURCES_DIR --out OUT
    python -m pidlink inverted --mapped DIR --out OUT
    python -m pidlink provenance --rdf RDF.zip --primary-ents DIR --non-mapped DIR --out OUT

Paths may be any file system Spark can read (zip archives: a path mounted on every host); ``spark.checkpoint.dir`` must name a shared
folder on a cluster.
"""

from __future__ import annotations

import argparse
import json

from pidlink.plans import jobs
from pidlink.session import build_session


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="pidlink")
    sub = p.add_subparsers(dest="job", required=True)
    m = sub.add_parser("mapping", help="Meta records -> mapped / multi-mapped / unmapped")
    m.add_argument("--meta", required=True)
    m.add_argument("--works", required=True)
    m.add_argument("--sources", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--new-only", action="store_true", help="skip records that already hold an openalex: id")
    m.add_argument("--index-table", help="store the PID index as this bucketed catalog table")
    m.add_argument("--index-buckets", type=int, default=0)
    m.add_argument("--rebuild-index", action="store_true", help="replace an index that is already there")
    m.add_argument("--single-file", action="store_true", help="write each multi-mapped table as one file")
    m.add_argument("--rows-per-file", type=int, default=10_000)
    for name, what in (("categorise", "categories of multi-mapped records"), ("analysis", "the flattened analysis tables")):
        c = sub.add_parser(name, help=what)
        c.add_argument("--multi-mapped", required=True)
        c.add_argument("--works", required=True)
        c.add_argument("--sources", required=True)
        c.add_argument("--out", required=True)
    i = sub.add_parser("inverted", help="1:1 pairs whose OpenAlex record several Meta records reach")
    i.add_argument("--mapped", required=True)
    i.add_argument("--out", required=True)
    v = sub.add_parser("provenance", help="provenance of unmapped records")
    v.add_argument("--rdf", required=True)
    v.add_argument("--primary-ents", required=True)
    v.add_argument("--non-mapped", required=True)
    v.add_argument("--out", required=True)
    p.add_argument("--master", help="Spark master (default: from spark-submit)")
    a = p.parse_args(argv)
    spark = build_session(a.master, app=f"pidlink-{a.job}")
    if a.job == "mapping":
        out = jobs.run_mapping(spark, a.meta, a.works, a.sources, a.out, all_rows=not a.new_only,
                               rows_per_file=a.rows_per_file, index_table=a.index_table, index_buckets=a.index_buckets,
                               rebuild_index=a.rebuild_index, single_file=a.single_file)
    elif a.job == "analysis":
        out = jobs.run_analysis_tables(spark, a.multi_mapped, a.works, a.sources, a.out)
    elif a.job == "inverted":
        out = jobs.run_inverted(spark, a.mapped, a.out)
    elif a.job == "categorise":
        out = jobs.run_categorisation(spark, a.multi_mapped, a.works, a.sources, a.out)
    else:
        out = jobs.run_provenance(spark, a.rdf, a.primary_ents, a.non_mapped, a.out)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
