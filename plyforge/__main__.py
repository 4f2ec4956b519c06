"""Command line: list queries, run one, ingest an archive, estimate sizes."""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="plyforge")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("queries")
    run = commands.add_parser("run")
    run.add_argument("name")
    run.add_argument("sf_dir")
    run.add_argument("--out")
    run.add_argument("--explain", action="store_true")
    ingest = commands.add_parser("ingest")
    ingest.add_argument("archive")
    ingest.add_argument("root")
    ingest.add_argument("--month")
    ingest.add_argument("--max-games", type=int)
    ingest.add_argument("--strict", action="store_true")
    ingest.add_argument("--dry-run", action="store_true")
    estimate = commands.add_parser("estimate")
    for name in ("sample_bytes", "sample_games", "games"):
        estimate.add_argument(name, type=int)
    args = parser.parse_args(argv)

    if args.command == "estimate":
        from plyforge.sources.config import estimated_bytes

        print(estimated_bytes(args.sample_bytes, args.sample_games, args.games))
        return 0
    from plyforge.plans import QUERIES

    if args.command == "queries":
        print("\n".join(sorted(QUERIES)))
        return 0
    from plyforge.session import local_session

    if args.command == "run":
        df = QUERIES[args.name](local_session(), args.sf_dir)
        if args.explain:
            df.explain("formatted")
        elif args.out:
            df.write.parquet(args.out)
        else:
            df.show(50, truncate=False)
        return 0
    import re

    from plyforge.plans.build import ingest as build
    from plyforge.sources.config import file_sha256

    month = args.month or (re.search(r"\d{4}-\d{2}", args.archive) or [None])[0]
    if not month:
        parser.error("the archive's name has no month; give --month")
    sha = file_sha256(args.archive)
    if args.dry_run:
        print(json.dumps({"archive_sha256": sha, "month": month}))
        return 0
    print(json.dumps(build(local_session(), [args.archive], args.root, sha, month, max_games=args.max_games, strict=args.strict)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
