"""Command line: python -m corvane.cli {prepare,score,select,calibrate,export} ..."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from corvane.plans import commands
from corvane.session import local_session, ship


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corvane")
    verbs = top.add_subparsers(dest="verb", required=True)
    p = verbs.add_parser("prepare")
    p.add_argument("manifest")
    p.add_argument("--voice", required=True, help="module:function that makes the voice model")
    p.add_argument("--speakers", help="module:function that makes the diarization model")
    p.add_argument("--identities", help="a JSON file with the identities of the models `vad` and `diarization`")
    p = verbs.add_parser("score")
    p.add_argument("manifest")
    p.add_argument("--stages", required=True, help="module:function that gives the list of stages")
    p.add_argument("--retry-errors", action="store_true")
    p = verbs.add_parser("select")
    p.add_argument("database")
    p.add_argument("--policy", required=True)
    p.add_argument("--profile", choices=("tts", "asr"), default="asr")
    p = verbs.add_parser("calibrate")
    p.add_argument("database")
    p.add_argument("--per-group", type=int, default=20)
    p.add_argument("--seed", default="0")
    p.add_argument("--labels")
    p.add_argument("--policy")
    p.add_argument("--profile", choices=("tts", "asr"), default="asr")
    p = verbs.add_parser("export")
    p.add_argument("selection")
    p.add_argument("--sample-rate", default="preserve")
    p.add_argument("--seed", default="0")
    p.add_argument("--train", type=float, default=0.9)
    p.add_argument("--validation", type=float, default=0.05)
    for p in verbs.choices.values():
        p.add_argument("--out", required=True)
    return top


def _found(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _json(path: str | None):
    if path is None:
        return None
    with open(path) as file:
        return json.load(file)


def main(argv: list[str] | None = None) -> int:
    """Prints JSON; 0 if all is well, 1 if records have errors, 2 if the command can't run."""
    args = parser().parse_args(argv)
    try:
        spark = local_session()
        ship(spark)
        if args.verb == "prepare":
            said = {"segments": commands.prepare(spark, args.manifest, args.out, _found(args.voice), args.speakers and _found(args.speakers), _json(args.identities))}
        elif args.verb == "score":
            said = commands.score(spark, args.manifest, args.out, _found(args.stages)(), args.retry_errors)
        elif args.verb == "select":
            said = commands.select(spark, args.database, _json(args.policy), args.out, args.profile)
        elif args.verb == "calibrate":
            said = {"cells": commands.calibrate(spark, args.database, args.out, args.per_group, args.seed, args.labels, _json(args.policy), args.profile)}
        else:
            rate = None if args.sample_rate == "preserve" else int(args.sample_rate)
            said = commands.export(spark, args.selection, args.out, rate, args.seed, args.train, args.validation)
    except (ValueError, OSError, RuntimeError) as problem:
        print(json.dumps({"error": str(problem)}))
        return 2
    print(json.dumps(said))
    return 1 if said.get("errors") or said.get("error") else 0


if __name__ == "__main__":
    sys.exit(main())
