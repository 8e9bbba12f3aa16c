"""Time queries and compare them with their SQL: python tests/llm/try_query.py dir name..."""

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), os.path.dirname(HERE)]

from compare import compare, connect  # noqa: E402
from tidemark.llm import queries  # noqa: E402
from tidemark.session import build_session  # noqa: E402

if __name__ == "__main__":
    spark = build_session(
        "try",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:]:
        start = time.time()
        df = queries.QUERIES[name](spark, sys.argv[1])
        if name in queries.ORACLES:
            print(name, compare(df, connect(sys.argv[1]), queries.ORACLES[name]), flush=True)
        else:
            rows = df.collect()
            print(name, len(rows), rows[:3], flush=True)
        print(f"{time.time() - start:.1f} s", flush=True)
