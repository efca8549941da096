"""Command line (H8), run with ``spark-submit`` or ``python -m shardload.cli``.

    import  --input PATH --output ROOT --index NAME [--type T] [--delim D]
            [--auto-id] [--meta FILE] [--shards N] [--split K] [--on-error fail|reject|null]
            [--format parquet|orc|json] [--all-field] [--rejects PATH]
    drop    --output ROOT
    current --output ROOT
"""

from __future__ import annotations

import argparse
import codecs
import sys

from shardload import DEFAULT_SHARDS, DEFAULT_TYPE


def _delim(text: str) -> str:
    """Accept escapes such as ``\\t`` on the command line."""
    return codecs.decode(text, "unicode_escape") if "\\" in text else text


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shardload")
    sub = p.add_subparsers(dest="cmd", required=True)
    imp = sub.add_parser("import", help="build and publish a sharded dataset from line files")
    imp.add_argument("--input", required=True, nargs="+")
    imp.add_argument("--output", required=True, help="dataset root")
    imp.add_argument("--index", required=True)
    imp.add_argument("--type", default=DEFAULT_TYPE)
    imp.add_argument("--delim", default="\\t")
    imp.add_argument("--auto-id", action="store_true")
    imp.add_argument("--shards", type=int, default=DEFAULT_SHARDS)
    imp.add_argument("--split", default="auto",
                     help="sub-partitions per shard: a number, or 'auto' (from the input size)")
    imp.add_argument("--range-bytes", type=int, help="cut each shard by the bytes of its lines instead, about so many a task")
    imp.add_argument("--on-error", default="fail", choices=("fail", "reject", "null"),
                     help="a bad value fails the import; or its document is kept apart; or the value is null")
    imp.add_argument("--format", default="parquet", choices=("parquet", "orc", "json"))
    imp.add_argument("--all-field", action="store_true", help="add the _all catch-all text")
    imp.add_argument("--source-dup", default="keep", choices=("keep", "last", "array"),
                     help="repeated field names in _source: keep all, last wins, or a JSON array")
    imp.add_argument("--rejects", help="also write the build's rejected values here (reject mode)")
    imp.add_argument("--meta", help="file with name:type,name:type for positional cells")
    imp.add_argument("--stop-words", default="english", choices=("english", "none"))
    imp.add_argument("--analyzer", default="standard", choices=("standard", "plain"),
                     help="words by Unicode word breaking, or runs of letters and digits")
    imp.add_argument("--build-id")
    imp.add_argument("--doc-values", help="write per-shard doc values for name:type,name:type")
    imp.add_argument("--stats", action="store_true", help="store field and term statistics of each shard")
    imp.add_argument("--postings", action="store_true", help="write the per-shard inverted index")
    for name in ("drop", "current"):
        s = sub.add_parser(name)
        s.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None, spark=None) -> str | None:
    args = build_parser().parse_args(argv)
    from shardload.plans.publish import current_build, publish, unpublish
    from shardload.session import get_spark
    spark = spark or get_spark()
    if args.cmd == "drop":
        unpublish(spark, args.output)
        return None
    if args.cmd == "current":
        build = current_build(spark, args.output)
        print(build or "")
        return build
    from shardload.operators.routing import auto_split
    from shardload.plans.build import shard_docs, shard_fields
    from shardload.plans.publish import check_doc_values, input_bytes, read_current_part
    from shardload.sources.lines import keyed_lines, numbered_lines, read_lines
    delim = _delim(args.delim)
    dv = None
    if args.doc_values:
        dv = {n.strip(): (t or "string").strip().lower()
              for n, _, t in (item.partition(":") for item in args.doc_values.split(",") if item.strip())}
        check_doc_values(dv)
    lines = numbered_lines(spark, args.input) if args.auto_id else read_lines(spark, args.input)
    split = auto_split(input_bytes(spark, args.input), args.shards) if args.split == "auto" else int(args.split)
    build_args = dict(shards=args.shards, split=split, with_all=args.all_field, source_dup=args.source_dup,
                      range_bytes=args.range_bytes)
    if args.meta:
        meta = "".join(r.value for r in spark.read.text(args.meta, wholetext=True).collect()).replace("\n", ",")
        docs = shard_fields(keyed_lines(lines, delim, args.auto_id), args.index, args.type, meta=meta, delim=delim,
                            on_error=args.on_error, **build_args)
    else:
        docs = shard_docs(lines, args.index, args.type, delim=delim, auto_id=args.auto_id, on_error=args.on_error,
                          **build_args)
    build = publish(docs, args.output, build_id=args.build_id, fmt=args.format, shards=args.shards,
                    doc_value_schema=dv, with_postings=args.postings, split=split,
                    stop_words=() if args.stop_words == "none" else None, analyzer=args.analyzer, with_stats=args.stats)
    if args.rejects and args.on_error == "reject":
        read_current_part(spark, args.output, "rejects", args.format).write.mode("errorifexists").parquet(args.rejects)
    print(build)
    return build


if __name__ == "__main__":
    main(sys.argv[1:])
