"""Command line: ``python -m shelfmark <job> …`` (or ``spark-submit`` this module)."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import functions as F

from shelfmark.operators.encode import hashed_words, sentence_transformer
from shelfmark.operators.similarity import TOP_K
from shelfmark.plans import jobs
from shelfmark.session import build_session
from shelfmark.sources.tables import matrix_shape, read_embeddings


def encoder(name: str):
    """``hashed[:dim]``, ``model:<name>`` for a sentence-transformers model, or
    ``module.path:function`` for a factory of your own."""
    kind, _, rest = name.partition(":")
    if kind == "hashed":
        return hashed_words(int(rest or 64))
    if kind == "model":
        return sentence_transformer(rest)
    return getattr(importlib.import_module(kind), rest)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfmark")
    parser.add_argument("--master", help="Spark master, when not run by spark-submit")
    sub = parser.add_subparsers(dest="job", required=True)

    p = sub.add_parser("merge", help="merge a JSON Lines collection")
    p.add_argument("root")
    p.add_argument("out")
    p.add_argument("--splits", nargs="*")
    p.add_argument("--lines-out")

    for name in ("embed-papers", "embed-subjects"):
        p = sub.add_parser(name, help="build an embedding table")
        p.add_argument("input")
        p.add_argument("out")
        p.add_argument("--encoder", default="hashed:64", help=encoder.__doc__)
        p.add_argument("--mode", choices=["skip", "failfast"])

    p = sub.add_parser("similar", help="rows most similar to one row of an embedding table")
    p.add_argument("table")
    p.add_argument("--row", type=int, default=0)
    p.add_argument("--split", help="the split that the row is of, for a table of papers")
    p.add_argument("-k", type=int, default=TOP_K)

    p = sub.add_parser("flatten", help="turn a JSON-LD tree into tables")
    p.add_argument("root")
    p.add_argument("out")

    p = sub.add_parser("embed-flattened", help="embed the papers and subjects of flattened documents")
    p.add_argument("input")
    p.add_argument("out")
    p.add_argument("--encoder", default="hashed:64", help=encoder.__doc__)

    p = sub.add_parser("suggest", help="the nearest subjects of every embedded paper")
    p.add_argument("embedded")
    p.add_argument("out")
    p.add_argument("-k", type=int, default=TOP_K)

    args = parser.parse_args(argv)
    spark = build_session(master=args.master)
    if args.job == "merge":
        for report in jobs.merge_with_report(spark, args.root, args.out, args.splits, lines_out=args.lines_out):
            report.orderBy("split").show(1000, truncate=False)
    elif args.job == "embed-flattened":
        for table in jobs.embed_flattened(spark, args.input, args.out, encoder(args.encoder)):
            matrix_shape(table).show()
    elif args.job == "suggest":
        jobs.write_suggestions(spark, args.embedded, args.out, args.k).show(truncate=False)
    elif args.job == "flatten":
        jobs.flatten_documents(spark, args.root, args.out)
    elif args.job == "similar":
        table = read_embeddings(spark, args.table, by="split" if args.split else None)
        if args.split:
            table = table.where(F.col("split") == args.split)
        jobs.similar_to(table, args.row, args.k).show(args.k, truncate=False)
    else:
        embed = jobs.embed_papers if args.job == "embed-papers" else jobs.embed_subjects
        mode = {"mode": args.mode} if args.mode else {}
        if args.job == "embed-papers":
            jobs.paper_outcomes(spark, args.input).orderBy("split", "outcome").show(truncate=False)
        matrix_shape(embed(spark, args.input, args.out, encoder(args.encoder), **mode)).show()


if __name__ == "__main__":
    main()
