"""Command line: ``python -m pitlake --root FOLDER COMMAND ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

COMMANDS = (
    "migrate ingest parse reprocess monitor ops-report review detect capture worklist load-index spot-check load-reference coverage universe set-doc-url backfill snapshot restore signals build-signals check queries run"
).split()


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="pitlake")
    p.add_argument("--root", default="pitlake-data", help="folder of the tables")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("what", nargs="*", help="files, folders, ids or names, as the command needs")
    day = dt.date.fromisoformat
    p.add_argument("--as-of", type=day, default=dt.date.today())
    p.add_argument("--max-market-cap", type=float)
    p.add_argument("--exclude-top", type=int)
    p.add_argument("--kind", default="cluster", choices=("cluster", "conviction", "registry", "listings", "business-numbers"))
    p.add_argument("--limit", type=int, default=50)
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--apply", action="store_true")
    p.add_argument("--allow-shrink", action="store_true")
    p.add_argument("--force", action="store_true", help="apply an extract again that is applied already")
    p.add_argument("--out", help="folder for a screen as CSV; without it the first rows are shown")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    from .plans.platform import Platform
    from .session import session

    spark = session()
    x = Platform(spark, a.root)
    show = lambda df: df.show(a.limit, truncate=False)

    def report(df) -> None:
        from .sources.files import write_csv

        write_csv(df, a.out) if a.out else show(df)

    if a.command == "queries":
        from .plans.catalog import QUERIES

        print("\n".join(sorted(QUERIES)))
    elif a.command == "run":
        from .plans.catalog import QUERIES

        show(QUERIES[a.what[0]](spark, a.what[1]))
    elif a.command == "migrate":
        print("made:", *x.migrate())
    elif a.command in ("ingest", "capture"):
        print(x.ingest(a.what[0]), "documents")
    elif a.command == "detect":
        print(x.detect(a.what[0]), "detections")
    elif a.command == "parse":
        show(x.parse())
    elif a.command == "reprocess":
        show(x.reprocess(a.apply))
    elif a.command == "monitor":
        found = x.monitor()
        show(found)
        return int(not found.isEmpty())
    elif a.command == "ops-report":
        print("\n".join(x.ops_report()))
    elif a.command == "review":
        if a.what[:1] == ["show"]:
            show(x.review_show(int(a.what[1])))
        elif a.what[:1] == ["resolve"]:
            x.review_resolve(int(a.what[1]), a.what[2], a.what[3] if len(a.what) > 3 else None)
        else:
            show(x.review_list(a.limit))
    elif a.command == "worklist":
        show(x.worklist(a.limit))
    elif a.command == "spot-check":
        show(x.spot_check(a.limit, a.seed))
    elif a.command == "load-index":
        show(x.load_index(a.what[0], a.as_of))
    elif a.command == "load-reference":
        source, apply = {
            "registry": ("registry", lambda: x.load_registry(*a.what)),
            "business-numbers": ("business-numbers", lambda: [x.load_business_numbers(path) for path in a.what]),
        }.get(a.kind, ("listings", lambda: x.load_listings(a.what[0], a.as_of, a.allow_shrink)))
        print(source, x.load(source, a.as_of, a.what, apply, a.force))
    elif a.command == "coverage":
        show(x.number_coverage())
        show(x.coverage())
    elif a.command == "universe":
        report(x.universe(a.as_of, a.max_market_cap, a.exclude_top))
    elif a.command == "set-doc-url":
        x.set_doc_url(int(a.what[0]), a.what[1])
    elif a.command == "backfill":
        show(x.backfill_from(*a.what))
    elif a.command == "snapshot":
        show(x.snapshot(a.what[0]))
    elif a.command == "restore":
        x.restore(a.what[0])
    elif a.command == "build-signals":
        x.build_signals()
    elif a.command == "signals":
        report(x.signals(a.kind))
    elif a.command == "check":
        show(x.check())
    return 0


if __name__ == "__main__":
    sys.exit(main())
