"""``python -m nimbria job.json [--set key=value]... [--list]``: run a product job, or list what it reads and makes."""

from __future__ import annotations

import argparse
import json

from nimbria.plans import jobs


def _value(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return text


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="nimbria", description=__doc__)
    parser.add_argument("config")
    parser.add_argument("--set", action="append", default=[], metavar="KEY=VALUE", help="override a setting (dots go deeper)")
    parser.add_argument("--recover", metavar="PATH", help="skip windows that the checkpoints there have")
    parser.add_argument("--override-input", help="location to read from")
    parser.add_argument("--override-output", help="location to write to")
    parser.add_argument("--list", action="store_true", help="list inputs and windows only")
    args = parser.parse_args(argv)
    changes: dict = {}
    for item in args.set:
        key, _, value = item.partition("=")
        node = changes
        *path, last = key.split(".")
        for name in path:
            node = node.setdefault(name, {})
        node[last] = _value(value)
    if args.recover:
        changes["recover"] = args.recover
    if args.override_input:
        changes.setdefault("source", {})["location"] = args.override_input
    if args.override_output:
        changes["target"] = args.override_output
    config = jobs.load(args.config, changes)
    if args.list:
        print(json.dumps(jobs.listing(config), indent=1))
        return
    from pyspark.sql import SparkSession

    jobs.run(SparkSession.builder.appName("nimbria").getOrCreate(), config)


if __name__ == "__main__":
    main()
