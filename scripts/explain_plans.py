"""Plan review: build real Parquet stores from the test views under the shared folder, run the
store-facing operators over real scans and print what matters in their physical plans
(pushed filters, read schemas, exchanges that carry payload columns, join strategies).

usage: python scripts/explain_plans.py [sf_dir] [--no-aqe] [--no-broadcast]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402


def summarize(name: str, df) -> None:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(f"== {name}")
    for m in re.findall(r"FileScan parquet [^\n]*", plan):
        cols = re.search(r"\[(.*?)\]", m)
        pushed = re.search(r"PushedFilters: \[(.*?)\]", m)
        schema = re.search(r"ReadSchema: (struct<.*?>)", m)
        print(f"   scan cols={cols.group(1)[:90] if cols else '?'}")
        if pushed and pushed.group(1):
            print(f"     pushed={pushed.group(1)[:160]}")
        if schema:
            print(f"     readSchema={schema.group(1)[:160]}")
    exch = re.findall(r"Exchange (hashpartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\)|SinglePartition)[^\n]*", plan)
    print(f"   exchanges={len(exch)} broadcast={plan.count('BroadcastExchange')} smj={plan.count('SortMergeJoin')} "
          f"bhj={plan.count('BroadcastHashJoin')} bnlj={plan.count('BroadcastNestedLoopJoin')} python={plan.count('ArrowEvalPython') + plan.count('MapInArrow') + plan.count('MapInPandas')}")
    from streetscape.plans.inspect import exchanges_carrying

    print(f"   shuffle exchanges carrying image_blob={exchanges_carrying(df, 'image_blob')}, brain_activity={exchanges_carrying(df, 'brain_activity')}")


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    from streetscape.operators import aoi as G
    from streetscape.operators import store as ST
    from streetscape.operators.deliverable import deliverable_rows
    from streetscape.plans import queries as Q
    from streetscape.plans import views as V
    from streetscape.schemas import IMAGE_COLUMNS, SCORE_COLUMNS
    from streetscape.session import get_session, shared_path
    from streetscape.sinks.stores import append_images, append_scores
    from streetscape.sources.stores import scan_image_store, scan_score_store

    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    if "--no-aqe" in sys.argv:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    if "--no-broadcast" in sys.argv:
        # the 100 TB case: no automatic broadcasts, explicit ones only behind is_small checks
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        from streetscape.operators import sizing

        sizing.DEFAULT_BROADCAST_BYTES = 0
    root = shared_path(spark, "plans")
    st = V.store(spark, sf)
    for shard in ("shard-1.parquet", "shard-2.parquet"):
        append_images(st.filter(F.col("source_file") == shard).select(*IMAGE_COLUMNS), f"{root}/images")
    append_scores(Q.score_view(spark, sf).select(*SCORE_COLUMNS), f"{root}/scores")
    images, scores = scan_image_store(spark, f"{root}/images"), scan_score_store(spark, f"{root}/scores")
    cand = G.within_bbox(V.captures(spark, sf), G.named_box("camden"))

    summarize("within_bbox over the image store", G.within_bbox(images, G.named_box("camden")).select("image_id"))
    summarize("new_images (J1)", ST.new_images(cand, images))
    summarize("working_set (J4)", ST.working_set(cand, images))
    summarize("latest_rows (A6)", ST.latest_rows(images))
    summarize("store_stats (A1)", ST.store_stats(images))
    summarize("deliverable (J5)", deliverable_rows(images, scores, G.named_box("camden")))
    summarize("collapse + parcel means + top-k (M4)", Q.score_view(spark, sf))
    summarize("multi_aoi_join (G6)", Q.q_multi_aoi_join(spark, sf))
    summarize("pseudo_clip_plan (W6)", Q.q_pseudo_clip_plan(spark, sf))


if __name__ == "__main__":
    main()
