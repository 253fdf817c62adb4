"""Run every registered query against its SQL: python tests/run_checks.py FOLDER [NAME ...]"""

import sys
import time
import traceback
from pathlib import Path

root = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(root), str(root / "tests")]

import __spark_entry__ as entry  # noqa: E402
from compare import database, difference, spark_table, sql_table  # noqa: E402
from ebbtide.session import local_session  # noqa: E402

folder, names = sys.argv[1], sys.argv[2:]
spark = local_session("8")
spark.sparkContext.setLogLevel("ERROR")
con = database(folder)
queries, sql = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or queries:
    start = time.time()
    try:
        got = spark_table(queries[name](spark, folder))
        took = time.time() - start
        note = difference(got, sql_table(con, sql[name])) if name in sql else f"rows only: {len(got[1])} {got[1][:2]}"
    except Exception as e:
        took, note = time.time() - start, "".join(traceback.format_exception_only(e))[:600]
    failed = note is not None and not note.startswith("rows only")
    bad += failed
    print(f"{'FAIL' if failed else 'ok  '} {took:6.2f}s {name} {note or ''}", flush=True)
print("failed:", bad)
