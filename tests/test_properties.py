"""Property tests (hypothesis): each example is a list of inputs checked
in one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions import fixed
from tidemark.functions import text as T
from tidemark.functions import tokens as K

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
# BMP text without surrogates or unassigned code points
TEXT = st.text(st.characters(min_codepoint=1, max_codepoint=0xFFFF,
                             blacklist_categories=("Cs", "Cn")), max_size=40)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_clean_text_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    once = df.select("i", T.clean_text("t").alias("c"))
    for r in once.select("*", T.clean_text("c").alias("again")).collect():
        assert r.again == r.c == r.c.strip()
        assert sum(ch.isalnum() for ch in r.c) == sum(ch.isalnum() for ch in texts[r.i])


KNOWN = st.sampled_from([w for w in fixed.VOCAB if w.strip() == w and w])


@SETTINGS
@given(st.lists(st.lists(KNOWN, max_size=80), min_size=1, max_size=20))
def test_encode_round_trip_property(spark, texts):
    """Known words come back as they were, whatever their number."""
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "i int, t string")
    ids = df.select("i", K.token_ids("t").alias("ids"))
    for r in ids.select("*", K.decode("ids").alias("back"), K.pad_truncate("ids", 128).alias("cut")).collect():
        assert r.back == " ".join(texts[r.i]) and len(r.ids) == len(texts[r.i])
        assert len(r.cut) == 128 and list(r.cut[:len(r.ids)]) == list(r.ids[:128])
        assert all(x in fixed.VOCAB.values() for x in r.cut)
