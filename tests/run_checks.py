"""Run registered queries against their SQL and print one line each.

    python tests/run_checks.py FOLDER [name …]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from compare import compare, connect  # noqa: E402

from sparkkit.oracle import ORACLE  # noqa: E402
from sparkkit.registry import QUERIES  # noqa: E402
from sparkkit.session import build_session  # noqa: E402


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session("checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in names or QUERIES:
        begin = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE:
                note = compare(df, ORACLE[name], connection)
            else:
                note = f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - begin:6.2f}s  {note[:700]}", flush=True)


if __name__ == "__main__":
    main()
