"""Properties from SURVEY 5.2: list cleanup is idempotent, the tone label is a total function."""

from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.functions import clean_list, list_comma, tone_label

LIST_TEXT = st.text(alphabet=st.sampled_from(list("ab C;;| \tXy,_")), max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), LIST_TEXT), min_size=1, max_size=20))
def test_list_cleanup_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    once = df.select(clean_list("c").alias("c"))
    twice = once.select(clean_list("c").alias("c"))
    assert once.collect() == twice.collect()
    once = df.select(list_comma("c").alias("c"))
    assert once.collect() == once.select(list_comma("c").alias("c")).collect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=32)),
                min_size=1, max_size=30))
def test_tone_label_total(spark, scores):
    df = spark.createDataFrame([(s,) for s in scores], "s float")
    labels = [r[0] for r in df.select(tone_label("s")).collect()]
    assert len(labels) == len(scores) and set(labels) <= {"negative", "neutral", "positive"}
    for s, lab in zip(scores, labels):
        if s is not None and s == s:
            assert lab == ("negative" if s < -2 else "positive" if s > 2 else "neutral")
