import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup


def weak(text):
    """A hash with many collisions: the length."""
    return F.length(text).cast("string")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    some = [(rng.choice([None, *range(40)]), rng.choice([None, "", "a", "b", "dd", "ee", "x" * 5000]), i % 3)
            for i in range(100)]
    # a repeated row whose id stays, null ids only, single rows
    return some + [(500, "u", 1), (501, "v", 1), (501, "w", 1), (None, "zz", 0), (None, "zz", 0)]


@pytest.mark.parametrize("hash_of", [exact_dedup.hash128, weak])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_against_brute_force(spark, rows, hash_of, keep):
    ids = defaultdict(list)
    for i, t, _ in rows:
        ids[t or ""].append(i)
    pick = max if keep == "largest" else min
    stay = {t: pick((i for i in v if i is not None), default=None) for t, v in ids.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string, _h int").repartition(3)
    got = exact_dedup.duplicate_groups(df, keep=keep, hash_of=hash_of)
    assert Counter(map(tuple, got.collect())) == Counter(
        (i, stay[t or ""], len(ids[t or ""]), i == stay[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
        for i, t, _ in rows)
    left = exact_dedup.drop_copies(df, keep=keep, hash_of=hash_of)
    assert left.columns == df.columns
    assert Counter((r.doc_id, r.text or "") for r in left.collect()) == Counter((i, t) for t, i in stay.items())


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
