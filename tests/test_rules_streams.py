
from umpire.functions.events import MSG_TRIGGERED, classify_arrivals, extract_log_metrics, match_events
from umpire.streaming.rendezvous import rendezvous_batch

from conftest import SF_SMALL


def test_arrival_rules(spark):
    df = spark.createDataFrame([
        ("data/b1/df.csv", "b1"), ("data/b1/y.csv", None), ("raw/df.csv", "b"),
        ("data/b2/z.csv", "b2"), ("data/b3/y.csv", "b3")], "key string, batch_id string")
    out = {r.key: (r.status, r.file_type, r.folder) for r in classify_arrivals(df).collect()}
    assert out["data/b1/df.csv"] == ("accepted", "df", "data/b1/")
    assert out["data/b1/y.csv"][0] == "missing_batch_id"
    assert out["raw/df.csv"][0] == "skipped"
    assert out["data/b2/z.csv"][0] == "unrecognized"
    assert out["data/b3/y.csv"] == ("accepted", "y", "data/b3/")


def _fold(seq):
    """(event id, message) of each arrival, one by one."""
    state, out = set(), []
    for i, t in seq:
        if ({"df", "y"} - {t}) & state:
            out.append((i, MSG_TRIGGERED))
            state = set()
        else:
            out.append((i, f"{t}.csv uploaded, waiting for the other file."))
            state.add(t)
    return out


def test_rendezvous_batch_equals_sequential_fold(spark):
    import random
    rnd = random.Random(3)
    rows, expected = [], []
    for b in range(30):
        # one busy batch id over many partitions, and small ones between
        seq = [(b * 10000 + i, rnd.choice(["df", "y"])) for i in range(1500 if b == 7 else rnd.randint(1, 12))]
        expected += _fold(seq)
        rows += [(str(b), i, i, t, f"data/{b}/", "accepted") for i, t in seq]
    rows += [("0", -1, -1, None, None, "skipped")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "batch_id string, event_id long, ts long, file_type string, folder string, status string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    before_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for partitions in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = sorted((r.event_id, r.message) for r in rendezvous_batch(df).collect())
            assert got == sorted(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", before_aqe)
    assert rendezvous_batch(df.where("false")).count() == 0


def test_event_pattern_prefix(spark):
    df = spark.createDataFrame([("s", "data/x"), ("s", "tmp/x"), ("t", "data/y")], "source string, key string")
    out = match_events(df, {"source": ["s"], "key": [{"prefix": "data/"}]}).collect()
    assert [(r.source, r.key) for r in out] == [("s", "data/x")]


def test_log_metric_extraction(spark):
    df = spark.createDataFrame([(1, "[3]#011train-auc:0.91#011validation_0-auc:0.8"), (2, "noise")],
                               "line_id long, value string")
    got = {(r.metric, r.metric_value) for r in extract_log_metrics(df, keep=["line_id"]).collect()}
    assert got == {("train:auc", 0.91), ("validation:auc", 0.8)}


def test_stream_rendezvous_matches_batch_twin(spark):
    import __spark_entry__ as E
    q = E.queries()
    a = sorted(tuple(r) for r in q["t1_rendezvous_stream"](spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in q["t1_rendezvous_batch"](spark, SF_SMALL).collect())
    assert a == b and len(a) > 0
