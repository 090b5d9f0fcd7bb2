"""Command line of the batch jobs, for ``spark-submit`` or ``python -m chartweave``."""

from __future__ import annotations

import argparse

from .plans import jobs
from .session import build_session
from .sources.layers import Lake
from .streaming.ingest import bundle_queue_stream, ingest_stream


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="chartweave")
    steps = parser.add_subparsers(dest="step", required=True)

    ingest = steps.add_parser("ingest", help="load the next batch of bundle files, or what a queue holds")
    ingest.add_argument("--input", help="folder of bundle files (source local)")
    ingest.add_argument("--folders", type=int, default=jobs.BATCH_FOLDERS, help="outer folders per batch")
    ingest.add_argument("--servers", help="queue servers (source kafka)")
    ingest.add_argument("--topic", help="queue topic (source kafka)")
    ingest.add_argument("--checkpoint", help="folder that keeps the stream's progress between runs (source kafka)")

    transform = steps.add_parser("transform", help="build the detail tables of the next batch")
    transform.add_argument("--database", help="also keep the detail tables in this catalog database")
    model = steps.add_parser("model", help="load the next batch into the star tables")
    model.add_argument("--prefix", help="also keep the star tables in catalog databases with this name prefix")
    model.add_argument("--url", help="also append all batches that are not there yet to this JDBC database")
    model.add_argument("--property", action="append", default=[], metavar="NAME=VALUE", help="JDBC property")
    merge = steps.add_parser("merge", help="merge all loaded batches into the stored rows of keyed star tables")
    profile = steps.add_parser("profile", help="profile the batches of all tables that have no profile yet")
    for step in (ingest, transform, model):
        step.add_argument("--resume", action="store_true", help="take over batches of jobs that were lost")
    for step in (ingest, transform, model, merge, profile):
        step.add_argument("--lake", required=True, help="root folder of all layers")
        step.add_argument("--source", choices=["local", "kafka"], default="local")

    images = steps.add_parser("images", help="header fields of image files to a table")
    images.add_argument("--input", required=True)
    images.add_argument("--table", default="image_data")
    images.add_argument("--pixels", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> int | None:
    parser = arguments()
    options = parser.parse_args(argv)
    spark = build_session(f"chartweave {options.step}")
    if options.step == "images":
        return jobs.extract_images(spark, options.input, options.table, options.pixels)
    lake = Lake(options.lake)
    if options.step == "profile":
        return jobs.profile(spark, lake)
    if options.step == "merge":
        return len(jobs.merge(spark, lake))
    lease = 0.0 if options.resume else jobs.LEASE_HOURS
    if options.step == "ingest" and options.source == "kafka":
        if not (options.servers and options.topic and options.checkpoint):
            parser.error("--servers, --topic and --checkpoint are needed for source kafka")
        stream = bundle_queue_stream(spark, options.servers, options.topic)
        ingest_stream(spark, stream, lake, options.checkpoint, options.source)
        return None
    if options.step == "ingest":
        if not options.input:
            parser.error("--input is needed for source local")
        return jobs.ingest(spark, lake, options.input, options.source, options.folders, lease)
    if options.step == "transform":
        return jobs.transform(spark, lake, options.source, options.database, lease)
    batch_id = jobs.model(spark, lake, options.source, options.prefix, lease)
    if options.url:
        properties = dict(p.split("=", 1) for p in options.property)
        jobs.export(spark, lake, options.url, properties, options.source)
    return batch_id


if __name__ == "__main__":
    done = main()
    print("nothing to do" if done is None else f"batch {done} done")
