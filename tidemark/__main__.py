"""python -m tidemark create | drop | replicate: the pipeline from a terminal."""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import fields
from importlib import import_module

from .config import SINKS, PipelineConfig


def _function(name: str):
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description="Settings come from flags, TIDEMARK_<NAME>, the file, and defaults, in this order.")
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("create", "drop"):
        admin = commands.add_parser(name, help=f"{name} a replication slot")
        admin.add_argument("--slot", required=True)
        admin.add_argument("--execute", required=True, help="module:function that runs one statement on a replication connection")
    run = commands.add_parser("replicate", help="stream a slot to a sink")
    run.add_argument("sink", choices=SINKS)
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--log", help="a file of messages, one JSON row a line")
    source.add_argument("--connect", help="module:function that makes a connection to a slot")
    run.add_argument("--slot", default="s0")
    run.add_argument("--checkpoint", required=True)
    run.add_argument("--send", help="module:function(batched, epoch) that writes a micro-batch; stdout needs none")
    run.add_argument("--config", help="a JSON or YAML file")
    run.add_argument("--once", action="store_true", help="stop when all that is there is replicated")
    for f in fields(PipelineConfig):
        if f.name != "sink":
            run.add_argument(f"--{f.name.replace('_', '-')}")
    return top


def settings(args: argparse.Namespace, env=os.environ) -> PipelineConfig:
    flags = {f.name: getattr(args, f.name) for f in fields(PipelineConfig) if getattr(args, f.name) is not None}
    return PipelineConfig.from_file(args.config, flags, env) if args.config else PipelineConfig.resolve(flags, env)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command != "replicate":
        from .sources import slot

        execute = _function(args.execute)
        if args.command == "drop":
            slot.drop_slot(execute, args.slot)
        elif not slot.create_slot(execute, args.slot):
            print(f"slot {args.slot} is there already")
        return 0

    from pyspark.sql import SparkSession

    from .sinks.wiring import sink_for
    from .sources.replay import ReplaySource
    from .sources.slot import SlotSource
    from .streaming.pipeline import replicate

    config = settings(args)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    spark.dataSource.register(ReplaySource)
    spark.dataSource.register(SlotSource)
    reader = spark.readStream.option("maxRowsPerBatch", str(config.client_buffer))
    raw = reader.format("wal_replay").option("path", args.log).load() if args.log else reader.format("wal_slot").option("connect", args.connect).option("slot", args.slot).load()

    if config.sink != "stdout" and not args.send:
        raise SystemExit(f"--send is needed for {config.sink}")
    send = _function(args.send) if args.send else sink_for(config)
    every = {"processingTime": f"{config.tick_ms} milliseconds"}
    query = replicate(raw, config, send, args.checkpoint, every)
    if args.once:
        query.processAllAvailable()
        query.stop()
    else:
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
