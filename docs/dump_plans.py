"""Write the formatted physical plans of the headline queries to docs/plans/.

The plans of the tables a query writes on its way come first, so the whole
work of the query is shown.  Usage: python docs/dump_plans.py [sf_dir]
"""

import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from affinity.operators import cooccurrence, similarity  # noqa: E402
from affinity.plans.queries import QUERIES  # noqa: E402
from affinity.session import build_session  # noqa: E402

NAMES = ("daily_events", "training_triples", "cco_all", "cco_orders", "outcome", "popularity_table",
         "vector_similarity", "text_similarity", "serving_table")


def formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def main(sf_dir: str) -> None:
    spark = build_session()
    for name in NAMES:
        parts: list[str] = []
        real = cooccurrence.stored

        def recording(df, table):
            parts.append(f"## written table {table}\n\n{formatted(df)}")
            return real(df, table)

        cooccurrence.stored = similarity.stored = recording
        try:
            df = QUERIES[name](spark, sf_dir)
        finally:
            cooccurrence.stored = similarity.stored = real
        head = f"# {name}: physical plans at {os.path.basename(sf_dir)} (session.CONF, local[8], before AQE re-planning)"
        with open(os.path.join(HERE, "plans", f"{name}.txt"), "w") as out:
            out.write("\n\n".join([head, *parts, f"## result\n\n{formatted(df)}"]).replace(f"file:{sf_dir}", "file:SF_DIR"))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
