"""A fitted preparation and model score a file stream exactly like the batch table."""

from tabstrata.operators import models as MD
from tabstrata.plans.pipeline import Preparation
from tabstrata.session import scratch_path, table
from tabstrata.sources.posts import posts_with_missing
from tabstrata.streaming.scoring import read_stream, score_stream, write_stream


def test_stream_scoring_equals_batch(spark):
    posts = posts_with_missing(table(spark, "/root/testdata/sf0.001", "events"))
    cfg = {"categorical": {"enabled": False}}
    prep = Preparation(cfg).fit(posts, "target", "post_id")
    feats = ["post_hour", "post_day", "k", "hour_sin", "hour_cos", "day_sin", "day_cos"]
    tr = prep.transform(posts)
    model = MD.train(tr, feats, "target", "linear")
    src = scratch_path(spark, "posts_src")
    posts.repartition(3).write.parquet(src)
    stream = read_stream(spark, src, posts.schema, max_files_per_trigger=1)
    scored = score_stream(stream, prep, model, keep=["post_id", "prediction"])
    out = scratch_path(spark, "posts_scored")
    q = write_stream(scored, out)
    q.awaitTermination(120)
    got = {r["post_id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    want = {r["post_id"]: r["prediction"] for r in MD.predict(model, tr).select("post_id", "prediction").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
