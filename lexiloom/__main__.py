"""The corpus and the core queries from a shell.

python -m lexiloom list | show NAME DIR [N] | explain NAME DIR | write NAME DIR OUT
python -m lexiloom init CORPUS | import-pages CORPUS SOURCE VOLUME | list-pages CORPUS [VOLUME] | reset-volume CORPUS VOLUME
python -m lexiloom detect-boundaries CORPUS [VOLUME] | export-articles CORPUS OUT [VOLUME] | corpus-export CORPUS OUT
"""

from __future__ import annotations

import importlib
import pkgutil
import sys

from lexiloom import commands, plans
from lexiloom.session import local_session

#: Commands on a corpus: what runs, and the fewest and most arguments.
CORPUS = {
    "init": (commands.init, 1, 1), "import-pages": (commands.import_pages, 3, 3), "list-pages": (commands.list_pages, 1, 2), "reset-volume": (commands.reset_volume, 2, 2),
    "detect-boundaries": (commands.detect_boundaries, 1, 2), "export-articles": (commands.export_articles, 2, 3), "corpus-export": (commands.corpus_export, 2, 2),
}


def queries() -> dict:
    modules = [importlib.import_module(f"lexiloom.plans.{m.name}") for m in pkgutil.iter_modules(plans.__path__)]
    return {name: q for m in modules for name, q in getattr(m, "QUERIES", {}).items()}


def main(args: list[str]) -> int:
    if args[:1] == ["list"]:
        print("\n".join(sorted(queries())))
        return 0
    if args and args[0] in CORPUS:
        run, least, most = CORPUS[args[0]]
        if least <= len(args) - 1 <= most:
            said = run(local_session(), *[int(a) if a.isdigit() else a for a in args[1:]])
            if said is not None:
                said.show(1000, truncate=100)
            return 0
    if len(args) < 3 or args[0] not in ("show", "explain", "write") or args[1] not in queries() or (args[0] == "write" and len(args) < 4):
        print(__doc__)
        return 2
    df = queries()[args[1]](local_session(), args[2])
    if args[0] == "show":
        df.show(int(args[3]) if len(args) > 3 else 20, truncate=100)
    elif args[0] == "explain":
        df.explain("formatted")
    else:
        df.write.parquet(args[3])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
