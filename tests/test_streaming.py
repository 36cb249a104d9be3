"""A streaming frame is assigned exactly as the same rows in a batch."""

import os

from segmint.operators.assign import assign, first_rows_as_centers
from segmint.operators.features import embedding_points
from segmint.streaming import assign_stream, cluster_sizes_stream

from conftest import SF_SMALL


def test_stream_assignment_equals_batch(spark, workdir):
    batch = embedding_points(spark, SF_SMALL)
    cents = first_rows_as_centers(batch, 8, "vec_id")
    src = os.path.join(workdir, "emb")
    batch.repartition(4).write.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    out = assign_stream(stream, cents)
    q = out.select("vec_id", "cluster", "d2").writeStream.format("memory").queryName("seg_assigned").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["vec_id"]: (r["cluster"], r["d2"]) for r in spark.table("seg_assigned").collect()}
    want = {r["vec_id"]: (r["cluster"], r["d2"]) for r in assign(batch, cents).collect()}
    assert got == want
    sizes_q = (
        cluster_sizes_stream(assign_stream(spark.readStream.schema(batch.schema).parquet(src), cents))
        .writeStream.format("memory").queryName("seg_sizes").outputMode("complete").trigger(availableNow=True).start()
    )
    sizes_q.awaitTermination(120)
    sizes = {r["cluster"]: r["member_count"] for r in spark.table("seg_sizes").collect()}
    batch_sizes = {r["cluster"]: r["count"] for r in assign(batch, cents).groupBy("cluster").count().collect()}
    assert sizes == batch_sizes
    assert sum(sizes.values()) == batch.count()


def test_stream_assignment_with_trained_model(spark, workdir):
    from segmint.operators.train import train_kmeans

    batch = embedding_points(spark, SF_SMALL)
    model = train_kmeans(batch, 6, seed=2)
    src = os.path.join(workdir, "emb2")
    batch.write.parquet(src)
    out = assign_stream(spark.readStream.schema(batch.schema).parquet(src), model)
    q = out.select("vec_id", "cluster", "d2").writeStream.format("memory").queryName("seg_model").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["vec_id"]: (r["cluster"], r["d2"]) for r in spark.table("seg_model").collect()}
    want = {r["vec_id"]: (r["cluster"], r["d2"]) for r in assign(batch, model).collect()}
    assert got == want
