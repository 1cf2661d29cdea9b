"""Side-by-side run of this subpackage's queries with their SQL: python tests/llm/compare.py [sf_dir] [query ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parents[1])]

if __name__ == "__main__":
    import __spark_entry__ as entry
    from compare import compare, connect
    from riskloom.session import local_session

    sf_dir = sys.argv[1]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:]:
        fn, sql, start = entry.queries()[name], entry.oracle_sql().get(name), time.time()
        note = compare(spark, connect(sf_dir), sf_dir, name, fn, sql) if sql else f"rows {fn(spark, sf_dir).count()}"
        print(name, note or "equal", f"{time.time() - start:.1f} s")
