"""Registered queries: against SQL where there is any, else that each
answers for every row of its table."""

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
import tiktoken
from test_mixing import shares
from test_ngram_join import brute

import __spark_entry__ as E
import corpus_pipeline
from tidemark.llm import bpe, quality
from tidemark.llm.queries import GOOD, GRADES, QUERIES, RANKS, SQL, grade

SF = "/root/testdata/sf0.001"
ROWS = {"op4_language_id": "documents", "op1_token_counts": "documents", "op2_quality": "documents",
        "op3_byte_bpe": "documents", "op7_line_dedup": "documents", "op9_ngram_join": "documents", "op12_substring_dedup": "documents"}


def norm(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(round(v, 9)) if isinstance(v, float) else str(v)


def test_registered():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(QUERIES)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    pick = lambda rows, cols: sorted("|".join(norm(r[cols.index(c)]) for c in sorted(names)) for r in rows)
    assert pick(df.collect(), df.columns) == pick(cur.fetchall(), names)


@pytest.mark.parametrize("name", sorted(ROWS))
def test_one_row_for_each_document(spark, name):
    ids = sorted(r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/{ROWS[name]}.parquet").select("doc_id").collect())


def test_pipeline_stages(spark):
    """Every stage works on all that its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
            after = [tuple(r) for r in out.collect()]
            assert set(after) <= set(before), name
            if name != "mixing":
                assert len(after) <= len(before), name
            docs = spark.createDataFrame(after, docs.schema)
            text = [r[columns.index("text")] for r in after]
            if name == "exact_dedup":
                assert len(set(text)) == len(text) == len({r[columns.index("text")] for r in before})
        else:
            assert out.count() == len(before)


def test_stages_on_odd_rows(spark, tmp_dir):
    """Nulls in every column, empty and long texts, repeated rows, columns
    whose names the operators use, and a table without rows."""
    rows = [(1, "plain words of one document", "en", "a", 3, "x"), (1, "plain words of one document", "en", "a", 3, "x"),
            (2, "PLAIN words of one document", "en", None, None, None), (None, None, None, None, None, None),
            (3, "", "de", "b", 0, "y"), (4, "long " * 30000, None, "b", 1, "z"), (5, None, "en", "a", 1, "z"),
            (None, "no id", "en", "c", 1, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string"
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 1), (None, 1, 0), (5, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, tmp_dir)
            got = [tuple(r) for r in out.collect()]
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns and set(got) <= {tuple(r) for r in data}, name
            else:
                assert len(got) == len(data)
            if name == "exact_dedup" and data:
                assert len(got) == len({r[1] or "" for r in data})
            if name == "ngram_join" and data:
                assert {r[0] for r in got} == {1, 3, 4, 5, None}


def mixed(rows):
    """How often each (id, text, source) is taken: documents in the order of
    their hash until the budget of the source is used up."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    out = {}
    for source, target in shares(sizes).items():
        epochs = int(target // sizes[source]) if sizes[source] else 0
        budget, used = target - epochs * sizes[source], 0
        for h, r in sorted((int(hashlib.md5(str(r[0]).encode()).hexdigest()[:12], 16), r) for r in rows if r[2] == source):
            upto = used + words(r[1])
            more = upto <= budget or upto - budget < budget - used
            out[r] = epochs + more
            if upto > budget:
                budget = -1  # nothing behind it
            used = upto
    return out


def test_pipeline_against_brute_force(spark):
    """``run`` against its stages done by hand; the classifier's model is the
    fitted one, its decisions are recomputed text by text."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), grade(), GRADES)
    scorer = quality.Scorer(model)
    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect())
    rows = [r for r in rows if model.above([scorer.score(r[1] or "")])[0, GOOD - 1] >= quality.KEEP]
    rows = [r for i, r in enumerate(rows) if (r[1] or "") not in {x[1] or "" for x in rows[:i]}]
    component = {i: c for _, i, _, c in brute([r[:2] for r in rows], corpus_pipeline.NEAR_N, corpus_pipeline.NEAR_PERCENT)}
    rows = [r for r in rows if component[r[0]] == r[0]]
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.read_ranks(public_tokenizers.path(RANKS)))
    want = Counter()
    for r, times in mixed(rows).items():
        ids = lib.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
             hashlib.sha256((r[1] or "").encode()).hexdigest()] += times
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(map(tuple, got.collect())) == +want
    assert corpus_pipeline.ORACLE_SQL is None
