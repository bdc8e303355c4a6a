"""Command line: one command for each stage, and run-all."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans import pipeline
from .sources import providers


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quarrylight", description="Company values from raw company files.")
    out.add_argument("--input", default="data/raw/companies.csv", help="raw company CSV")
    out.add_argument("--output-dir", default="data/processed", help="folder of the stages' tables")
    out.add_argument("--config", help="recorded in the manifest")
    out.add_argument("--resume", action="store_true", help="keep finished rows")
    out.add_argument("--force", action="store_true", help="start over")
    out.add_argument("--workers", type=int, default=5, help="requests at the same time")
    out.add_argument("--seed", type=int, default=42, help="seed of the sample")
    out.add_argument("--translate", action="store_true", help="with run-all: translate at the end")
    out.add_argument("--embedder-model", help="ONNX file of a sentence model; without one, hashed words stand in")
    out.add_argument("--embedder-tokenizer", help="tokenizer.json of that model")
    commands = out.add_subparsers(dest="command")
    for name in ("prepare-companies", *pipeline.STAGES, "run-all"):
        commands.add_parser(name)
    return out


def main(argv: list[str] | None = None, run: pipeline.Run | None = None) -> int:
    """run: the run to use instead of one over the network (for tests)."""
    args = parser().parse_args(argv)
    if not args.command:
        parser().print_help()
        return 0
    if bool(args.embedder_model) != bool(args.embedder_tokenizer):
        parser().error("--embedder-model and --embedder-tokenizer go together")
    if run is None:
        embedder = providers.OnnxEmbedder(args.embedder_model, args.embedder_tokenizer) if args.embedder_model else providers.HashEmbedder()
        spark = SparkSession.builder.appName("quarrylight").getOrCreate()
        run = pipeline.Run(spark, args.output_dir, providers.HttpFetcher(), embedder, providers.StopwordDetector(), providers.ChatTranslator(), args.resume, args.force, args.seed, args.workers)
    if args.command == "prepare-companies":
        said = pipeline.prepare(run, args.input)
    elif args.command == "run-all":
        said = pipeline.run_all(run, args.input, args.translate, f"{args.output_dir}/run_manifest.json")
    else:
        said = pipeline.STAGES[args.command](run)
    print(json.dumps(said, indent=2, default=str))
    return 0
