"""Write the physical plans of the load and of representative queries to
PLANS.md (``python tools/dump_plans.py [sf_dir]``).

The plans are those of large tables: broadcasts are off, but for dimensions
whose counted size allows them."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martflow.operators import load as L  # noqa: E402
from martflow.operators.enrich import enrich  # noqa: E402
from martflow.plans import olap, star  # noqa: E402
from martflow.operators.summary import merge_sums, partial_sums  # noqa: E402
from martflow.plans.warehouse import known_keys, open_warehouse  # noqa: E402
from martflow.session import build_session  # noqa: E402
from martflow.sources.testdata import testdata_feed  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    wh = open_warehouse(spark, sf)
    # the test tables are small enough for Spark to broadcast all of them
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    large = star.broadcast_limit(wh)
    customers_and_products_too_large = 8_000

    def without_large(q):
        """With customers and products over the bound, as on large tables."""
        spark.conf.set(star.BROADCAST_LIMIT_CONF, str(customers_and_products_too_large))
        try:
            return plan(q(wh))
        finally:
            spark.conf.set(star.BROADCAST_LIMIT_CONF, str(large))

    items = [
        ("enrich (feed x masters, before staging)", enrich(testdata_feed(spark, sf))),
        ("keys of a batch for all dimensions (one scan)", L.batch_keys(wh.staged())),
        ("new customers: rows of their earliest date, after the scan shared by all dimensions",
         L.dimension_rows(wh.staged(), L.batch_keys(wh.staged()), {})[0]["dim_customer"]),
        ("known keys of the fact in the buckets of a batch", known_keys(wh, [3, 77])),
        ("fact load: insert-ignore against the key index", L.fact_sales(wh.staged(), known_keys(wh, list(range(256))))),
        ("kept store x quarter summary after a load", merge_sums(wh.table("store_quarter_sums"), partial_sums(wh.fact))),
        ("Q3 occupation x category, customers and products large", without_large(olap.q3)),
        ("Q10 category x occupation, customers and products large", without_large(olap.q10)),
        ("Q4 product affinity top 5", olap.q4(wh)),
        ("Q14 store x quarter in one year", olap.q14(wh)),
        ("Q17 rollup store, supplier, category, year", olap.q17(wh)),
        ("Q19 revenue spikes", olap.q19(wh)),
    ]
    spark.conf.set("spark.sql.maxMetadataStringLength", "200")
    out = [f"# Physical plans\n\nGenerated by `tools/dump_plans.py` on `{sf}` "
           f"(local, Spark {spark.version}, AQE on, size-based broadcasts off; `isFinalPlan=false` is the plan "
           "before runtime re-optimisation).\n"]
    for title, df in items:
        out.append(f"## {title}\n\n```\n{df if isinstance(df, str) else plan(df)}\n```\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
