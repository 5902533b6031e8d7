from driftline.sources.files import parse_events


def test_reasons_of_odd_bodies(spark):
    """The text of the features tells as well whether a body could be read."""
    good = '{"model":"m","timestamp":1.5,"features":{"a":1.0},"prediction":2.0}'
    cut, unnamed, word = "not a JSON object", "no model", "a feature is not a number"
    bodies = [(good, None), (good[:-1], cut), (good[:20], cut), ("5", unnamed), ("", cut), (good.replace("1.0", "NaN"), cut),
              (good.replace("features", "feature"), "no features"), (good.replace('"m"', "null"), unnamed),
              (good.replace("1.0", '"high"'), word), (good.replace('{"a":1.0}', "{}"), None), (good.replace("2.0", "03"), cut)]
    parsed = parse_events(spark.createDataFrame([(k, b) for k, (b, _) in enumerate(bodies)], "event_id long, payload string"))
    assert [r["reason"] for r in parsed.orderBy("event_id").collect()] == [reason for _, reason in bodies]
