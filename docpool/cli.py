"""Command line: analyze, analyze-all, rerun-failed, aggregate-stats, make-data, select, emit, chunk."""

from __future__ import annotations

import argparse
import json
import math
import sys

from pyspark.sql import SparkSession

from docpool.plans import commands
from docpool.sources import config, jsonl, sinks


def _gate_options(p: argparse.ArgumentParser, prefix: str = "") -> None:
    p.add_argument(f"--{prefix}min_image_num", type=int, default=1)
    p.add_argument(f"--{prefix}token_total_max", type=int, default=config.BOUNDLESS)
    p.add_argument(f"--{prefix}layout_decision_ok", default="")
    p.add_argument(f"--{prefix}layout_score_min", type=float, default=-math.inf)
    p.add_argument(f"--{prefix}nsfw_decision_ok", default="")
    p.add_argument(f"--{prefix}nsfw_score_max", type=float, default=math.inf)
    p.add_argument(f"--{prefix}languages_ok", default="")
    p.add_argument("--chapter_level", type=int)


def _gates(a: argparse.Namespace, prefix: str = "") -> config.GatesConfig:
    get = lambda n: getattr(a, prefix + n)
    lists = {n: config.comma_list(get(n)) for n in ("layout_decision_ok", "nsfw_decision_ok", "languages_ok")}
    numbers = {n: get(n) for n in ("min_image_num", "token_total_max", "layout_score_min", "nsfw_score_max")}
    return config.GatesConfig(**lists, **numbers, chapter_level=a.chapter_level, token_total_min=getattr(a, "token_total_min", 0))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docpool")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, dataset: bool = True) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        if dataset:
            p.add_argument("--root", default=".")
            p.add_argument("--dataset_name", required=True)
            p.add_argument("--jsonl_dir_name", default=jsonl.FOLDER)
        return p

    p = command("analyze")
    p.add_argument("--out_dir", required=True)
    p.add_argument("--jsonl_glob", default=jsonl.SHARDS)
    p.add_argument("--viz_reservoir_size", type=int, default=200_000)
    p.add_argument("--max_records", type=int)
    p.add_argument("--seed", type=int, default=1337)
    p.add_argument("--sweep_token_total_min_list", default="")
    _gate_options(p, "base_")
    for name in ("analyze-all", "rerun-failed"):
        p = command(name, False)
        p.add_argument("--pool_root", required=True)
        p.add_argument("--out_root", required=True)
        p.add_argument("--jsonl_dir_name", default=jsonl.FOLDER)
        p.add_argument("--parallel", type=int, default=4)
        p.add_argument("--retries", type=int, default=1)
        p.add_argument("--redo", action="store_true")
        if name == "rerun-failed":
            p.add_argument("--failed_list", help="names, one a line; <out_root>/failed.list if not given")
    p = command("aggregate-stats", False)
    p.add_argument("--out_root", required=True)
    p.add_argument("--output_json")
    p.add_argument("--datasets_list", default="")
    p = command("make-data", False)
    for name in ("pool_root", "out_root", "output_version", "config"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--layouts", nargs="*", default=[], help="layout files, or patterns of them")
    p.add_argument("--run_mode", default="make_data")
    p.add_argument("--dataset_name", default="")
    p.add_argument("--jsonl_dir_name", default=jsonl.FOLDER)
    p.add_argument("--jsonl_glob", default=jsonl.SHARDS)
    p = command("select")
    p.add_argument("--output_dir", required=True)
    p.add_argument("--sample_total", type=int, required=True)
    p.add_argument("--category_ratio_json", required=True)
    p.add_argument("--token_total_min", type=int, default=0)
    p.add_argument("--seed", type=int, default=1337)
    _gate_options(p)
    p = command("emit")
    p.add_argument("--selected_manifest", required=True)
    p.add_argument("--output_dir", required=True)
    p = command("chunk")
    p.add_argument("--input_dir", required=True)
    p.add_argument("--output_dir", required=True)
    p.add_argument("--chapter_level", type=int, required=True)
    p.add_argument("--layouts", nargs="*", default=[], help="layout files, or patterns of them; without any, those that records name")
    p.add_argument("--image_token_guess", type=int, default=0)
    p.add_argument("--drop_empty", type=int, default=1)
    p.add_argument("--debug", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"docpool {a.command}").getOrCreate()
    folder = f"{a.root.rstrip('/')}/{a.dataset_name}/{a.jsonl_dir_name}" if "root" in a else ""
    if a.command == "analyze":
        thresholds = [int(x) for x in a.sweep_token_total_min_list.split(",") if x.strip()]
        commands.analyze(spark, folder, a.dataset_name, a.out_dir, sample_size=a.viz_reservoir_size, seed=a.seed, max_records=a.max_records, cfg=_gates(a, "base_"), thresholds=thresholds, shards=a.jsonl_glob)
    elif a.command in ("analyze-all", "rerun-failed"):
        only = None
        if a.command == "rerun-failed":
            only = commands.read_name_list("\n".join(r["value"] for r in spark.read.text(a.failed_list or f"{a.out_root.rstrip('/')}/failed.list").collect()))
        result = commands.analyze_all(spark, a.pool_root, a.out_root, redo=a.redo, retries=a.retries, folder=a.jsonl_dir_name, parallel=a.parallel, only=only, lists=True)
        print(json.dumps(result))
        return int(any(r.startswith("failed") for r in result.values()))
    elif a.command == "aggregate-stats":
        names = commands.read_name_list(open(a.datasets_list, encoding="utf-8").read()) if a.datasets_list else None
        commands.aggregate_stats(spark, a.out_root, a.output_json, names)
    elif a.command == "make-data":
        cfg = config.load_make_config(a.config)
        if cfg.run_mode != a.run_mode:
            print(f"the configuration's run_mode is {cfg.run_mode}", file=sys.stderr)
        layouts = jsonl.read_layouts(spark, a.layouts) if a.layouts else None
        print(json.dumps(commands.make_data_pool(spark, a.pool_root, a.out_root, a.output_version, cfg, layouts, a.dataset_name, a.jsonl_dir_name, a.jsonl_glob)))
    elif a.command == "select":
        quotas = config.quotas(config.parse_ratios(a.category_ratio_json), a.sample_total)
        commands.select(spark, folder, quotas, _gates(a), a.seed, f"{a.output_dir.rstrip('/')}/selected_manifest.json")
    elif a.command == "emit":
        commands.emit(spark, folder, commands.read_manifest(spark, a.selected_manifest), a.output_dir)
    elif a.command == "chunk":
        records = jsonl.read_records(spark, f"{a.input_dir.rstrip('/')}/jsonl_res_sample")
        layouts = jsonl.read_layouts(spark, a.layouts) if a.layouts else jsonl.named_layouts(spark, commands.chunk_files(records))
        chunks, bad = commands.chunk(records, layouts, a.chapter_level, image_tokens=a.image_token_guess, drop_empty=bool(a.drop_empty))
        if a.debug and (first := bad.first()) is not None:
            raise RuntimeError(f"no title for the slots of record {first['record_id']}")
        sinks.write_shards(commands.chunk_lines(chunks), a.output_dir, "jsonl_res_chunk", empty=records.select("dataset", "shard"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
