"""Print the physical plans of the headline queries (condensed): scans, exchanges, joins, aggregates.

    python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from segmint.operators.assign import assign, first_rows_as_centers  # noqa: E402
from segmint.operators.features import (  # noqa: E402
    assemble_vectors,
    customer_brand_counts,
    dimension_table,
    embedding_points,
    user_actions,
)
from segmint.operators.profile import cluster_profile, cluster_summary  # noqa: E402
from segmint.operators.runs import k_curve  # noqa: E402
from segmint.operators.score import score_many  # noqa: E402
from segmint.operators.sparse import assemble_sparse, assign_sparse, cluster_summary_sparse  # noqa: E402
from segmint.operators.train import train_kmeans  # noqa: E402
from segmint.plans.monthly import month_counts  # noqa: E402
from segmint.session import local_session  # noqa: E402
from segmint.sources import sinks  # noqa: E402

KEEP = re.compile(
    r"(Scan|Exchange|Join|Aggregate|Window|Generate|MapIn|ArrowEvalPython|BatchEvalPython|"
    r"WholeStageCodegen|TakeOrdered|Limit|Sort |LocalTableScan|PushedFilters|ReadSchema)"
)


def condensed(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            out.append(line.rstrip()[:220])
    return "\n".join(out)


def main(root: str) -> None:
    spark = local_session(8)
    pts, dims = user_actions(spark, root)
    cents = first_rows_as_centers(pts, 4, "user_id")
    emb = embedding_points(spark, root)
    ecents = first_rows_as_centers(emb, 16, "vec_id")
    model = train_kmeans(emb, 16)
    counts = customer_brand_counts(spark, root)
    bdims = dimension_table(counts, "p_brand")
    q_b = bdims.count()
    sp = assemble_sparse(counts, bdims, "o_custkey", "p_brand")
    bcents = first_rows_as_centers(assemble_vectors(counts, bdims, "o_custkey", "p_brand"), 8, "o_custkey")
    cases = {
        "features (F4 events → vectors)": pts,
        "brand counts (F6 join)": counts,
        "brand vectors": assemble_vectors(counts, dimension_table(counts, "p_brand"), "o_custkey", "p_brand"),
        "month counts (pipeline, two months)": month_counts(spark, root, ["199601", "199602"]),
        "assign, tiny k·Q (expression)": assign(pts, cents),
        "assign, k=16 Q=64 (Arrow batches)": assign(emb, ecents),
        "assign, trained model (Spark ML prediction, JVM)": assign(emb, model),
        "cluster summary (Summarizer)": cluster_summary(assign(emb, ecents), 64),
        "nested profile": cluster_profile(assign(pts, cents), cents, dims, "r"),
        "k-curve (10 runs × 4 k)": k_curve(emb, "label", "vec_id", [2, 4, 8, 16], 64),
        "sweep scoring, 3 models in one pass": score_many(emb, {k: first_rows_as_centers(emb, k, "vec_id") for k in (4, 8, 16)}),
        "sparse assignment + summary": cluster_summary_sparse(assign_sparse(sp, bcents), q_b),
        "membership lines": sinks.membership_lines(
            sinks.membership_rows(assign(pts, cents).withColumn("user_id", F.col("user_id").cast("string")), "r")
        ),
    }
    for name, df in cases.items():
        print(f"### {name}\n```\n{condensed(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
