"""Every operator on odd tables: nulls, empty and long texts, ties, repeated rows, clashing names, no rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import bpe, fingerprints, jaccard, linededup, mixing, pii, suffixes, topk, toxicity, warc
from ledgerloom.llm.queries import tokenizer_json

ODD = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, ids string, spans int, key int, a int, doc int, label int, mix_slot int"
LONG = "word " * 30_000
ROWS = [
    (1, "one two three four five six seven", "en", "s", 1),
    (2, None, None, None, None),
    (3, "", "en", "s", 0),
    (4, LONG, "en", "t", 150_000),
    (5, "one two three four five six seven", "en", "s", 1),
    (5, "one two three four five six seven", "en", "s", 1),
    (None, "no id here\n\nbut two lines", "de", "s", 9),
    (7, "  \n \t ", "fr", None, 5),
    (8, "x" * 40_000, "en", "s", 40_000),
]


@pytest.fixture(params=["odd", "empty"])
def docs(rows, request):
    data = [(*r, 1, "i", 2, 3, 4, 5, 6, 7) for r in ROWS] if request.param == "odd" else []
    return rows(ODD, data).repartition(3)


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda x: (x is None, x))


def test_document_operators_keep_one_row_for_each(docs, spark):
    expected = ids(docs)
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    results = {
        "bpe": bpe.round_trip(docs, tokenizer_json()),
        "pii": pii.find(docs),
        "toxicity": docs.select("doc_id", toxicity.score(model, F.col("text")).alias("score")),
        "mixing": mixing.mix(docs),
        "lines": linededup.drop_later_copies(docs),
        "fingerprints": fingerprints.fingerprint_edits(docs),
        "jaccard": jaccard.join(docs),
        "suffixes": suffixes.remove_repeats(docs),
    }
    for name, df in results.items():
        assert ids(df) == expected, name


def test_values_of_odd_documents(rows):
    docs = rows(ODD, [(*r, 1, "i", 2, 3, 4, 5, 6, 7) for r in ROWS])
    coded = {(r.doc_id, r.decoded) for r in bpe.round_trip(docs, tokenizer_json()).collect()}
    assert coded == {(r[0], r[1] or "") for r in ROWS}
    linked = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()}
    assert linked == {1: (3, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (3, 1), None: (2, None), 7: (0, 7), 8: (1, 8)}
    kept = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(docs).collect()}
    assert kept[4] == kept[8] == b"" and kept[3] == kept[2] == b"" and kept[1] == ROWS[0][1].encode()
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint_edits(docs).collect()}
    assert prints[1] == prints[5] and prints[2] == prints[3] and len(set(prints.values())) == 6
    mixed = mixing.mix(docs).collect()
    assert len({r.mix_position for r in mixed}) == len(ROWS)
    lines = {r.doc_id: (r.n_lines, r.n_deleted, r.text) for r in linededup.drop_later_copies(docs).collect()}
    assert lines[2] == (0, 0, None) and lines[3] == (1, 0, "") and lines[None][0] == 3


def test_pages_and_vectors(rows, tmp_path):
    shape = "page_id long, url string, html string, archive string, records int"
    same = "p" * 150
    data = [(3, "u", same), (1, None, same), (2, "a b\r\nc", None), (4, "u", "é" * 50), (5, "u", "é" * 50), (6, "", "x"), (7, "u", "x"), (None, "u", same)]
    for k, table in enumerate((data, [])):
        folder = f"{tmp_path}/w{k}"
        read = warc.read_archives(warc.write_archives(rows(shape, [(*r, "z", 1) for r in table]), folder), folder).collect()
        found = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in read}
        if table:
            assert found == {
                1: ("response", None, 150), 3: ("revisit", 1, 150), 2: ("response", None, 0), 4: ("response", None, 100),
                5: ("revisit", 4, 100), 6: ("response", None, 1), 7: ("response", None, 1), None: ("response", None, 150),
            }
        else:
            assert read == []
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, None), (6, [inf, 1.0]), (None, [9.0, 9.0]), (7, []), (8, [-1.0])]
    shape = "vec_id long, embedding array<float>, score int, rank int"
    found = topk.search(rows(shape, [(*v, 1, 1) for v in vectors]), F.col("vec_id") % 50 == 0, k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [(0, 1, 1, 81920), (0, 2, 2, 81920), (0, 3, 7, 0)]
    assert topk.search(rows(shape, []), F.col("vec_id") % 50 == 0).collect() == []


def test_topk_with_large_components(rows):
    """Finite components of any size take part; scores are summed exactly and then held within 64 bits."""
    rnd, most = random.Random(5), 2**63 - 1
    large = [0.0, 1.0, -1.0, 0.003, -0.003, 2.0**45 + 0.5, -(2.0**53), 3e9, 1e30, -1e30, 2e30, 1.7e308]
    vectors = [(i, [rnd.choice(large) if rnd.random() < 0.4 else rnd.uniform(-2, 2) for _ in range(4)]) for i in range(300)]
    exact = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v in vectors}
    expected = []
    for q in range(0, 300, 50):
        scores = sorted((-max(-most, min(most, sum(x * y for x, y in zip(exact[q], v)))), i) for i, v in exact.items() if i != q)
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    found = topk.search(rows("vec_id long, embedding array<double>", vectors), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == expected


def test_pii_refuses_prose_with_full_stops():
    for text in ("*** at.&&", "$$ at.&&", "anines. At and. Of", "look at this. It is", "a at b.1", "at.home"):
        assert not pii.plausible("email", text), text
    for text in ("jane [at] example [dot] com", "j.doe at mail.example.org", "jane dot doe at example dot com", "ann(at)host.net", "zoë@bücher.de"):
        assert pii.plausible("email", text), text


def test_stages_take_odd_documents(docs, spark, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert "doc_id" in out.columns
        out.collect()
