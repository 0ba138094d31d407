"""Text operators against plain versions, the tokenizers library, or what is known of the input."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, fingerprints, jaccard, linededup, pii, shingles, suffixes
from ledgerloom.llm import toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def noise(seed, letters, n=400, longest=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def test_bpe_equals_the_library(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.RankArray(open(path, encoding="utf-8").read())
    every = [*texts.values(), "", "<|endoftext|>", "a<|endoftext|><|endoftext|> b  ", "x" * 3000, "ab" * 900 + " " + "é" * 300, "it's 'll ''s 're! 've", "\x1c\x1d \x85　 "]
    every += noise(1, [*"ab \n\t'sTé1½²!.日🎉\xa0\x1c", "<|endoftext|>", "'re", "'ll"])
    sizes, ids = own.encode(every)
    for text, mine, theirs in zip(every, np.split(ids, np.cumsum(sizes)[:-1]), library.encode_batch(every, add_special_tokens=False)):
        assert mine.tolist() == theirs.ids, text[:80]
        assert own.decode(mine) == library.decode(theirs.ids, skip_special_tokens=False)


def test_words_are_those_of_the_pattern():
    pattern = regex.compile(bpe.WORDS)
    for text in filter(None, noise(2, "ab \n\t'srevldm1½!.日\xa0　")):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = bpe.word_starts(points, np.array([len(points)]))
        assert [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])] == pattern.findall(text)


def test_word_names_that_clash_are_caught(monkeypatch):
    monkeypatch.setattr(bpe, "_BASE", np.uint64(0))  # all words of more than one letter get clashing names
    own = bpe.RankArray(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    assert own.decode(own.encode(["some other words, and more"])[1]) == "some other words, and more"


def test_personal_data_patterns(texts):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def plain(text):
        for kind, pattern in kinds.items():
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m.group())
                fits = {
                    "email": lambda: True,
                    "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits),
                    "phone": lambda: 9 <= len(digits) <= 15,
                }[kind]()
                if fits:
                    yield (kind, *m.span())

    for text in [*texts.values(), *noise(3, "ab@.-+ ()0123459%_é\n", 5000), "4111 1111-1111 1111 1.2.3.4.5.6.7.8 a@b.c@d.e.f +1 (212) 555-0199"]:
        assert [(s.kind, s.start, s.end) for s in pii.base_spans(text)] == list(plain(text))


def test_the_field_learns_its_table_and_leaves_prose_alone(texts):
    field = pii.train()
    rows, labels = pii.taught()
    assert [x.tolist() for x in field.viterbi(rows)] == labels
    new = ["call (415) 555-0136 now", "mail sam dot hill at example dot org today", "in 1905 and 2004 of 300"]
    found = pii.added_spans(new, [pii.base_spans(t) for t in new], field)
    assert [[s.kind for s in own] for own in found] == [["phone"], ["email"], []]
    base = [pii.base_spans(t) for t in texts.values()]
    assert sum(map(len, pii.added_spans(list(texts.values()), base, field))) < 5


def test_windows_are_wherever_a_span_can_be():
    """Every plausible span holds a sign, each sign has one window of bounded length, and spelt signs count in any case."""
    rnd, parts, kept = random.Random(6), ["jane", "x", " ", ".", "_", "-", "\n", "AT", "at", "At", "(", ")", "[", "]", "@", "dot", "DOT", "é", "7", "42", "٣"], 0
    for _ in range(40_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        found = pii.signs(text, pii.tokens_of(text, 0, len(text))[0])
        if any(pii.plausible(k, text) for k in pii.KINDS):
            kept += 1
            assert found, text
    assert kept > 100
    for n in (1, 50, 400):
        words = sorted(rnd.sample(range(1000), n))
        own = [(a, b, [w for w in words if first <= w < after]) for a, b, first, after in pii.windows(words, 1000)]
        assert [w for _, _, inside in own for w in inside] == words
        assert all(b - a <= 4 * pii.REACH + 1 and a <= max(0, w - pii.REACH) and min(1000, w + pii.REACH + 1) <= b for a, b, inside in own for w in inside)
    assert pii.plausible("email", "jane (at) example (dot) com") and pii.plausible("email", "JANE AT EXAMPLE DOT COM")
    far = "and so the day went on without any word from them " * 5
    for text in ("write to jane [AT] example [DOT] com soon", f"{far}\nwrite to jane [At] example [Dot] com soon"):
        assert [text[s.start : s.end].lower() for s in pii.added_spans([text], [[]], pii.train())[0]] == ["jane [at] example [dot] com"]


def test_lines(rows):
    rnd = random.Random(4)
    pool = [" ".join(rnd.choice("abcdef") * 3 for _ in range(rnd.randint(0, 9))) for _ in range(12)]
    docs = [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30)))) for k in range(40)]
    words = lambda line: len([w for w in line.split(" ") if w])
    own = {k: [(n, x, words(x)) for n, x in enumerate(t.split("\n")) if words(x)] for k, t in docs}
    seen, dead = {}, {k: set() for k, _ in docs}
    for k, lines in own.items():  # every run, not only the shortest
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(x[2] for x in lines[a:b]) >= 12:
                    if seen.setdefault(tuple(x[1] for x in lines[a:b]), (k, a)) < (k, a):
                        dead[k] |= set(range(lines[a][0], lines[b - 1][0] + 1))
    found = linededup.drop_later_copies(rows("doc_id long, text string", docs), min_words=12).collect()
    for r in found:
        text = dict(docs)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for n, x in enumerate(text) if n not in dead[r.doc_id]), r.doc_id
        assert r.n_deleted == len(dead[r.doc_id])
    assert sum(r.n_deleted for r in found) > 20


@pytest.mark.parametrize("blank", ["\t", "\u00a0", "\u3000", "\r", "\x0b\x0c", "\x1c", "\x85", "\u2028"])
def test_lines_count_words_by_any_white_space(rows, blank):
    passage = [blank.join(f"c{n}x{k}" for k in range(20)) for n in range(3)]
    assert 50 < sum(len(line.split()) for line in passage)
    short = blank.join(f"s{k}" for k in range(30))
    empty = blank * 60
    docs = [(1, "\n".join(["one", *passage, short])), (2, "\n".join(["two", *passage, "end", short])), (3, f"three\n{empty}"), (4, f"four\n{empty}")]
    found = {r.doc_id: (r.n_deleted, r.text) for r in linededup.drop_later_copies(rows("doc_id long, text string", docs)).collect()}
    assert found == {1: (0, docs[0][1]), 2: (3, f"two\nend\n{short}"), 3: (0, docs[2][1]), 4: (0, docs[3][1])}


def test_fingerprints(rows, texts):
    found = {r.doc_id: r for r in fingerprints.fingerprint_edits(rows("doc_id long, text string", list(texts.items()))).collect()}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, other = texts[i], texts[order[(k + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + other[:cut]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert len({r.fingerprint for r in found.values()}) == len(set(texts.values()))
    assert sum(r.near_edited > r.near_next for r in found.values()) > 0.97 * len(found)


def test_fingerprints_are_sums_of_paragraphs(rows):
    from pyspark.sql import functions as F

    docs = rows("doc_id long, text string", [(1, "a b c d\ne f g"), (2, "e f g\na b c d"), (3, "a b c d"), (4, "e f g"), (5, "a b c e\nd f g")])
    v = fingerprints.vectors(docs, ["doc_id"], "text").collect()
    v = {r.doc_id: r for r in v}
    assert (v[1].exact, v[1].packs) == (v[2].exact, v[2].packs) != (v[5].exact, v[5].packs)
    pair = rows("x array<long>, y array<long>", [(v[3].packs, v[4].packs)]).select(
        fingerprints.added(F.col("x"), F.col("y"), (1 << 60) - 1).alias("sum"),
        fingerprints.removed(fingerprints.added(F.col("x"), F.col("y"), (1 << 60) - 1), F.col("y"), (1 << 60) - 1).alias("back"),
    )
    assert pair.first()["sum"] == v[1].packs and pair.first()["back"] == v[3].packs


def near_copies(seed, n=120):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(1, 60))] for _ in range(n // 6)]
    docs = []
    for k in range(n):
        own = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(len(own))] = f"v{rnd.randint(0, 9)}"
        docs.append((k, " ".join(own)))
    return docs


def components(docs):
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                same = len(sets[a] & sets[b])
                if same and 100 * same >= 75 * len(sets[a] | sets[b]) and least[a] > least[b]:
                    least[a], changed = least[b], True
    return {i: (len(sets[i]), least[i]) for i in sets}


@pytest.mark.parametrize("part, usual", [(4000, True), (3, False)])
def test_jaccard_groups(rows, monkeypatch, part, usual):
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "FAN", 3)
    if not usual:  # every shingle that occurs counts as frequent, so that lists are cut into parts
        monkeypatch.setattr(jaccard.np, "median", lambda x: 0)
    docs = near_copies(5)
    found = jaccard.join(rows("doc_id long, text string", docs).repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(docs)


@pytest.mark.parametrize("ids", ["none", "repeated", "mixed"])
def test_jaccard_tells_rows_apart(rows, ids):
    """Near copies without an id, or with one that other texts have too: as if each row had an id of its own."""
    docs = near_copies(8)
    name = {"none": lambda i: None, "repeated": lambda i: i % 7, "mixed": lambda i: [None, i % 5, i][i % 3]}[ids]
    real = components(docs)
    least = {}
    for i, (_, c) in real.items():
        if name(i) is not None:
            least[c] = min(least.get(c, name(i)), name(i))
    want = sorted(((name(i), n, least.get(c)) for i, (n, c) in real.items()), key=repr)
    frame = rows("doc_id long, text string, extra long", [(name(i), t, i) for i, t in docs]).repartition(4)
    assert sorted((tuple(r) for r in jaccard.join(frame).collect()), key=repr) == want
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    groups = {i: c for i, (_, c) in real.items()}
    left = [(r.doc_id, r.extra) for r in kept.collect()]
    assert sorted(groups[e] for _, e in left) == sorted(set(groups.values()))
    assert all(i == least.get(groups[e]) for i, e in left)


def test_postings_pack(monkeypatch):
    rnd = np.random.default_rng(3)
    columns = [rnd.integers(0, 1 << 63, 50).astype(np.uint64) * np.uint64(2), *(rnd.integers(0, 99, 50).astype(k) for k in (np.int32, np.int64, np.int32, np.int32))]
    got = jaccard._unpacked(jaccard._packed(columns))
    order = np.argsort(columns[0], kind="stable")
    assert all((g == c[order]).all() and g.dtype == c.dtype for g, c in zip(got, columns))


def test_shingle_sets():
    a, b, c, d = shingles.sets([b"A b\x0bC d e f", b"a  b c\td e F", b"a b c", b"a b d"])
    assert (a == b).all() and len(a) == 2 and len(c) == len(d) == 1 and c[0] != d[0]


def test_repeated_bytes(rows, texts):
    rnd = random.Random(6)
    pieces = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(20, 260))) for _ in range(8)]
    docs = [(k, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 8)))) for k in range(60)]
    docs += [(1000 + k, t) for k, t in texts.items()] + [(5000, "z" * 700), (5001, "ab" * 300)]
    raw, count = {i: t.encode() for i, t in docs}, {}
    for b in raw.values():
        for k in range(len(b) - 199):
            count[b[k : k + 200]] = count.get(b[k : k + 200], 0) + 1
    for r in suffixes.remove_repeats(rows("doc_id long, text string", docs).repartition(4)).collect():
        b = raw[r.doc_id]
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        assert bytes(r.kept) == bytes(x for x, g in zip(b, gone) if not g), r.doc_id
        assert len(r.spans) == int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    from pyspark.sql import functions as F

    model = toxicity.fit(docs, labels)
    held = docs.join(labels.where(toxicity.held_out(F.col("doc_id"))), "doc_id").select("toxic", toxicity.score(model, F.col("text")).alias("s")).collect()
    right = sum((r.s >= 0.5) == (r.toxic == 1) for r in held)
    toxic = [r.s >= 0.5 for r in held if r.toxic == 1]
    assert right > 0.97 * len(held) and sum(toxic) > 0.9 * len(toxic)


def test_label_model_discounts_voters_that_agree_with_each_other():
    rnd = np.random.default_rng(0)
    y = rnd.random(4000) < 0.2
    good = [np.where(y, rnd.random(4000) < 0.8, rnd.random(4000) < 0.02) for _ in range(4)]
    echo = rnd.random(4000) < 0.3  # says nothing of y, but four times over
    votes = np.stack([*good, echo, echo, echo, echo], axis=1).astype(float)
    belief = toxicity.label_model(votes, y.astype(int))
    assert ((belief > 0.5) == y).mean() > 0.97


def test_bpe_tables_travel_small_and_forget():
    """Workers get arrays, not the file's objects, and drop the words of a task; ids stay those of a fresh table."""
    import pickle

    own = bpe.RankArray(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    texts = ["Some words, some more words", "", "a" * 500 + " caf\u00e9 \U0001f600", "words again"]
    want = [part.tolist() for part in own.encode(texts)]
    sent = pickle.loads(pickle.dumps(own))
    assert not [v for v in vars(bpe.RankArray(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())).values() if isinstance(v, dict) and len(v) > 1000]
    for _ in range(2):
        assert [part.tolist() for part in sent.encode(texts)] == want
        assert len(sent.names) and sent.decode(want[1]) == "".join(texts)
        sent.forget()
        assert not len(sent.names) and not len(sent.flat) and "rank" not in vars(sent)


def test_workers_get_rows_in_small_batches(spark):
    """Texts reach workers a few MB at a time after any of the three operators, and jaccard takes few of them at once."""
    import zlib

    import pyarrow as pa

    from ledgerloom.llm.common import SLICE_BYTES

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two three"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    wide = spark.range(0, 2000, 1, 1).select("id", F.repeat(F.lit("word "), 1600).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    tokenizer = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    for operator in (lambda: jaccard.join(docs), lambda: toxicity.fit(docs, labels), lambda: bpe.round_trip(docs, tokenizer)):
        spark.conf.unset(setting)
        operator()
        found = wide.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in found) == 2000
        assert max(r.bytes for r in found) < 2 * SLICE_BYTES
    spark.conf.set(setting, "1m")  # what the session says holds
    jaccard.join(docs)
    assert spark.conf.get(setting) == "1m"
    spark.conf.unset(setting)

    text = b"some words " * 10_000
    rows = pa.RecordBatch.from_pydict({"key": list(range(20)), "packed": [zlib.compress(text)] * 20})
    slices = [texts for _, texts in jaccard.unpacked(iter([rows]))]
    assert sum(map(len, slices)) == 20
    assert max(sum(map(len, texts)) for texts in slices) < SLICE_BYTES // 2
