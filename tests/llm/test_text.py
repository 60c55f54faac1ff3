"""Tokens, languages, fingerprints and personal data against brute force."""

import gc
import hashlib
import json
import re
import tracemalloc
import zlib
from itertools import pairwise, product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField
from tokenizers import Tokenizer

from hazardlens.llm import bpe, fingerprints, language, mixing, privacy
from hazardlens.llm.common import add_columns
from tests.llm.cases import ROWS, docs, empty, listed, order, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# --- rows in Python ------------------------------------------------------------


def test_rows_reach_python_in_small_batches(spark):
    """Whole Arrow batches lie in memory, in the JVM and in Python."""
    table = spark.range(400).select(F.repeat(F.lit("x"), F.lit(50_000)).alias("text")).coalesce(1)
    told = add_columns(table, ["text"], [StructField("n", LongType())], lambda: lambda text: (len(text),))
    sizes = told.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long")
    assert 0 < sizes.agg(F.max("size")).first()[0] < 5_000_000
    assert told.groupBy("n").count().collect() == [(50_000, 400)]


# --- BPE -----------------------------------------------------------------------

HARD = [
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "  a\n\n b's 12³ ½\x1c\x1d \xa0　x", "日本語 😀😀",
    "\x00\x01�", "a" * 3000, "͸ unassigned ꟎", "I'll we're 'S don't", "\r\n\r\n \t end ", "ﬁ ǅ İ",
    " ".join(chr(i) + "a" + chr(i) + "1" for i in range(256)),
]


def test_bpe_is_the_librarys(spark):
    library = Tokenizer.from_file(VOCABULARY)
    rows = [*ROWS, *[(500 + i, t, "en", "a", 0) for i, t in enumerate(HARD)]]
    want = []
    for row in rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        want.append((row[0], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert listed(bpe.digests(docs(spark, rows), VOCABULARY)) == order(want)
    assert bpe.digests(empty(spark), VOCABULARY).count() == 0


def test_bpe_keeps_no_vocabulary_between_tasks():
    with open(VOCABULARY, encoding="utf-8") as file:
        spec = file.read()
    codec = bpe._codec(spec)
    assert bpe._codec(spec) is codec
    del codec
    gc.collect()
    assert not bpe._CODECS


def test_bpe_replaces_columns_of_its_names_and_keeps_others(spark):
    df = docs(spark, ROWS[:4]).withColumn("IDS", F.lit(1)).withColumn("extra", F.lit("x"))
    again = bpe.decode(bpe.encode(docs(spark, ROWS[:9]), VOCABULARY), VOCABULARY)
    assert all(r.decoded == (r.text or "") for r in again.collect())
    found = bpe.encode(df, VOCABULARY)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "ids", "n_tokens"]
    assert {r.extra for r in found.collect()} == {"x"}


def test_cuts_are_certain():
    codec = bpe.Codec(open(VOCABULARY, encoding="utf-8").read())
    for token in codec.token:
        assert not codec.cut[list(token[:-1]), list(token[1:])].any()
    assert codec.cut.any()


def test_tokens_are_merged_to_themselves():
    library = Tokenizer.from_file(VOCABULARY)
    spec = json.loads(open(VOCABULARY, encoding="utf-8").read())
    names = [n for n in spec["model"]["vocab"]]
    letters = bpe.byte_letters()
    whole = [(n, bytes(letters[c] for c in n)) for n in names]
    codec = bpe.Codec(open(VOCABULARY, encoding="utf-8").read())
    for name, raw in whole[:: 37]:
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        assert codec.encode(text) == np.array(library.encode(text).ids, "<u4").tobytes(), name


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    codec = bpe.Codec(open(VOCABULARY, encoding="utf-8").read())
    library = Tokenizer.from_file(VOCABULARY)
    for text in ["one two three four five " * 3, "six one " + "x" * 200, prose(1, 50)]:
        assert codec.encode(text) == np.array(library.encode(text).ids, "<u4").tobytes()


# --- language ------------------------------------------------------------------

FRENCH = "le chat est sur la table et il regarde la pluie qui tombe sur les toits de la ville".split()
GERMAN = "die katze sitzt auf dem tisch und sieht dem regen zu der auf die dächer der stadt fällt".split()
ENGLISH = "the cat is on the table and it watches the rain that falls on the roofs of the town".split()


def made_up(seed, words, count=40):
    rng = np.random.default_rng(seed)
    return " ".join(words[i] for i in rng.integers(0, len(words), count))


def language_rows(count=60):
    rows = []
    for i in range(count):
        for k, (lang, words) in enumerate((("fr", FRENCH), ("de", GERMAN), ("en", ENGLISH))):
            rows.append((3 * i + k, made_up(3 * i + k, words), lang, "a", 0))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = language_rows()
    return language.train([r[1] for r in rows], [r[2] for r in rows])


def test_language_of_texts_held_out(spark):
    blank = [(910 + r[0], *r[1:]) for r in ROWS[3:7]]
    rows = [*language_rows(), *blank, (900, "123 --- 456", "en", "a", 0), (901, made_up(5, FRENCH), None, None, 0)]
    found = {r.doc_id: r for r in language.predict(docs(spark, rows)).collect()}
    assert len(found) == len(rows)
    for row in rows:
        got = found[row[0]]
        assert got.held_out == (zlib.crc32(str(row[0]).encode()) % 4 == 2)
        assert 0 <= got.score <= 1
    held = [r for r in rows[:180] if found[r[0]].held_out]
    assert held and all(found[r[0]].lang_pred == r[2] for r in held)
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (914, 915, 916, 917, 900))
    assert found[901].lang_pred == "fr"


def test_nothing_to_learn(spark):
    rows = [(1, "some text", None, "a", 0), (None, "some text", "en", "a", 0)]
    assert {r.lang_pred for r in language.predict(docs(spark, rows)).collect()} == {"und"}
    assert language.predict(empty(spark)).count() == 0


def test_marginals_are_those_of_forward_backward(model):
    texts = [made_up(1, FRENCH, 70) + " " + made_up(2, ENGLISH, 45), "", None, "die", made_up(3, GERMAN, 200)]
    found, _ = language.shares(model, texts)
    for text, share in zip(texts, found, strict=True):
        _, grams, first, lexicon = language.word_features((text or "").lower())
        e, t = np.exp(model.emissions(grams, first, lexicon)), np.exp(model.transitions)
        if not len(e):
            assert not share.any()
            continue
        alpha, beta = np.zeros(e.shape), np.ones(e.shape)
        alpha[0] = np.exp(model.first) * e[0]
        for i in range(1, len(e)):
            alpha[i] = (alpha[i - 1] @ t) * e[i]
            alpha[i] /= alpha[i].sum()
        for i in range(len(e) - 2, -1, -1):
            beta[i] = t @ (e[i + 1] * beta[i + 1])
            beta[i] /= beta[i].sum()
        both = alpha * beta
        assert np.allclose((both / both.sum(axis=1, keepdims=True)).mean(axis=0), share, atol=1e-9)
    # code-switched text is shared between its languages
    assert abs(found[0][model.languages.index("fr")] - 70 / 115) < 0.1


def test_gradient_is_that_of_the_likelihood():
    texts, labels = ["le chat dort la", "the cat", "die katze und"], [1, 0, 2]
    words = language._Words.of(texts)
    rng = np.random.default_rng(3)
    rows, truth = language.sequences(words.texts, labels, 3, 2, rng)
    assert (rows[:, -1] < 0).all() and set(truth[rows >= 0]) == {0, 1, 2}
    model = language.Model(["en", "fr", "de"], rng.normal(0, 0.3, (language._SIZE, 3)), rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3))

    def likelihood():
        total = 0.0
        for row, gold in zip(rows, truth, strict=True):
            own = [int(w) for w in row if w >= 0]
            e = model.emissions(*words.take(np.array(own)))
            every = []
            for path in product(range(3), repeat=len(own)):
                score = model.first[path[0]] + sum(e[i, k] for i, k in enumerate(path))
                every.append(score + sum(model.transitions[a, b] for a, b in pairwise(path)))
                if list(path) == [int(g) for g in gold if g >= 0]:
                    right = every[-1]
            total += right - np.logaddexp.reduce(every)
        return total / len(rows)

    rows, truth = rows[:, :7], truth[:, :7]
    found = language.gradient(model, words, rows, truth)
    spots = [(0, (int(words.lexicon[2]), 1)), (0, (int(words.grams[0][3]), 2)), (1, (0, 2)), (1, (1, 1)), (2, (1,))]
    for which, at in spots:
        x = (model.weights, model.transitions, model.first)[which]
        before, sides = x[at], []
        for step in (1e-5, -1e-5):
            x[at] = before + step
            sides.append(likelihood())
        x[at] = before
        assert abs((sides[0] - sides[1]) / 2e-5 - found[which][at]) < 1e-6


def invented(seed):
    """Words of a language of its own."""
    rng = np.random.default_rng(seed)
    letters = rng.permutation(list("abcdefghijklmnopqrstuvwxyzäöüßéèñçåøæđłşžćýþðœñ"))[:14]
    return ["".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(40)]


def test_languages_of_short_documents(spark):
    rng = np.random.default_rng(2)
    rows = [(i, made_up(i, (FRENCH, ENGLISH)[i % 2]), ("fr", "en")[i % 2], "a", 0) for i in range(120)]
    rows += [(200 + i, made_up(i, GERMAN, 6), "de", "a", 0) for i in range(60)]
    kana = [chr(c) for c in range(0x3041, 0x3060)]
    rows += [(300 + i, "".join(rng.choice(kana, 12)), "ja", "a", 0) for i in range(60)]
    found = {r.doc_id: r.lang_pred for r in language.predict(docs(spark, rows)).collect()}
    wrong = [r for r in rows if found[r[0]] != r[2]]
    assert len(wrong) <= 4


def test_seventy_languages(spark):
    names = [f"l{i:02d}" for i in range(70)]
    rows = [(100 * i + j, made_up(i * j, invented(i), 30), names[i], "a", 0) for i in range(70) for j in range(12)]
    model = language.learn(docs(spark, rows), each=40)
    assert model.languages == names
    found = {r.doc_id: r.lang_pred for r in language.identify(docs(spark, rows), model).collect()}
    assert sum(found[r[0]] == r[2] for r in rows) > 0.98 * len(rows)
    cut = language.learn(docs(spark, rows), in_all=70, each=2)
    assert cut.languages == names


def test_long_texts_in_bounded_memory():
    few = language.train([made_up(i, (FRENCH, ENGLISH)[i % 2]) for i in range(20)], ["fr", "en"] * 10, each=50)
    text = made_up(1, FRENCH, 20_000) + " " + made_up(2, ENGLISH, 5_000)
    found, usual = language.shares(few, [text, "the cat", text[:9]])
    assert abs(found[0][1] - 0.8) < 0.02 and found[1][0] > 0.5 and usual[0] > few.limit
    rng = np.random.default_rng(1)
    many = language.Model([f"l{i:02d}" for i in range(64)], rng.normal(0, 1, (language._SIZE, 64)).astype(np.float32),
                          rng.normal(0, 1, (64, 64)), np.zeros(64))
    chunk = language.CHARS * language._FEW // 64
    tracemalloc.start()
    language.shares(many, [made_up(3, ENGLISH, chunk // 5)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_lanes_change_nothing(model, monkeypatch):
    texts = [made_up(i, (FRENCH, ENGLISH, GERMAN)[i % 3], n) for i, n in enumerate((1, 31, 32, 33, 64, 65, 200, 7))]
    found = language.shares(model, texts)[0]
    monkeypatch.setattr(language, "_FEW", 0)
    assert np.allclose(found, language.shares(model, texts)[0], atol=1e-12)


@pytest.mark.parametrize("count", [1, 3, 8])
def test_texts_of_no_known_language_are_told(count):
    own = [FRENCH, ENGLISH, GERMAN, *[invented(i) for i in range(20, 25)]][:count]
    texts = [made_up(10 * k + i, words) for k, words in enumerate(own) for i in range(40)]
    model = language.train(texts, [f"l{i // 40}" for i in range(len(texts))], each=100)
    junk = ["xqzt kvvw pqrz zzxk wqpv jjkx " * 3, "кот сидит на столе и смотрит на дождь", made_up(1, invented(99), 30)]
    clean = [made_up(900 + i, words, 25) for i, words in enumerate(own)] + [own[0][0], ""]
    assert (language.shares(model, junk)[1] < model.limit).all()
    assert (language.shares(model, clean)[1] >= model.limit).all()


# --- fingerprints --------------------------------------------------------------


def weighted_by_hand(text):
    terms = [t for t in re.split("[ \t-\r]+", text.lower()) if t]
    total, votes = 0, np.zeros(64, np.int64)
    for term in terms:
        h, total = xxhash.xxh64_intdigest(term.encode(), seed=42), total + len(term)
        votes += np.array([h >> b & 1 for b in range(64)]) * len(term)
    return sum(1 << b for b in range(64) if 2 * int(votes[b]) > total)


def edits_by_hand(rows):
    key = lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest())
    line = sorted(rows, key=key)
    prints = [weighted_by_hand(r[1] or "") for r in line]
    out = []
    for i, row in enumerate(line):
        text, after = row[1] or "", (i + 1) % len(line)
        last = len(text) // 3
        edited = text[: len(text) - last] + (line[after][1] or "")[:last]
        fp, efp = prints[i], weighted_by_hand(edited)
        near = None
        if row[0] is not None and row[0] % 100 == 0:
            near = sum((fp ^ p).bit_count() <= 3 for p in prints) - 1
        like = lambda a, b: 1 - (a ^ b).bit_count() / 64
        out.append((row[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{fp:016x}", f"{efp:016x}",
                    like(fp, efp), like(fp, prints[after]), near))
    return order(out)


@pytest.mark.parametrize("count", [1, len(ROWS)])
def test_fingerprints_and_edits(spark, count):
    rows = ROWS[:count]
    found = fingerprints.with_edits(docs(spark, rows))
    digits = [F.lpad(F.lower(F.hex(c)), 16, "0") for c in ("fp", "edited_fp")]
    got = found.select("doc_id", "n_chars", "edited_sha256", *digits, "near_edited", "near_next", "n_near")
    assert listed(got) == edits_by_hand(rows)


def test_no_documents_no_fingerprints(spark):
    assert fingerprints.with_edits(empty(spark)).count() == 0


def test_block_tables_lose_no_neighbour(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 63), 1 << 63, 30, np.int64).tolist()
    prints = set(base) | {0, -1}
    for value in base:
        for _ in range(6):
            mask = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            changed = (value ^ mask) & ((1 << 64) - 1)
            prints.add(changed - (1 << 64 if changed >> 63 else 0))
    asked = spark.createDataFrame([(p,) for p in base], "fp long")
    stored = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = {(a, b) for a in base for b in prints if a != b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    assert {tuple(r) for r in fingerprints.neighbours(asked, stored).collect()} == want


# --- personal data -------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(c) for c in digits[-1::-2]]
    even = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def base_by_hand(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


PERSONAL = [
    (600, "a@b.com._%+x@c.de x@y name@x@y.z.w@q.r", "en", "a", 0),
    (601, "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.255 1.2.3 256.1.1.1", "en", "a", 0),
    (602, "4111 1111 1111 1111 4111-1111-1111-1112 +1 (366) 555-9807. +1 2 + 3", "en", "a", 0),
    (603, "é@x.y " + "a" * 50_000 + " b@c.d.e.f-", "en", "a", 0),
    (604, "1" * 20_000 + " " + "1.2." * 2_000 + " x@a" + ".b" * 5_000, "en", "a", 0),
    (605, "😀 +49 30 1234567, then 10.0.0.1 😀 and me@here.org", "en", "a", 0),
    (605, "😀 +49 30 1234567, then 10.0.0.1 😀 and me@here.org", "en", "a", 0),
]


def test_base_spans(spark):
    rows = [*ROWS, *PERSONAL]
    want = []
    for row in rows:
        found = base_by_hand(row[1] or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        counts = [sum(k == kind for k, *_ in found) for kind in PLAIN]
        want.append((row[0], *counts, hashlib.sha256(line.encode()).hexdigest()))
    report = privacy.report(docs(spark, rows).withColumn("row", F.lit("clash")))
    assert listed(report.drop("spans")) == order(want)
    assert privacy.report(empty(spark)).count() == 0


def test_words_that_give_an_entity_away(spark):
    rows = [(i, f"{prose(i, 30)} nothing here", "en", "a", 0) for i in range(60)]
    rows += [(100 + i, f"{prose(i, 5)} contact Zebulon at zeb@corp.org {prose(i + 1, 5)}", "en", "a", 0) for i in range(4)]
    rows += [(200 + i, "the same copy of Unusual text with one@copy.org in it", "en", "a", 0) for i in range(5)]
    spans = {r.doc_id: r.spans for r in privacy.report(docs(spark, rows)).collect()}
    for i in range(4):
        text = rows[60 + i][1]
        at = text.index("Zebulon")
        assert f"term:{at}:{at + 7}" in spans[100 + i].split(",")
        assert f"email:{text.index('zeb@')}:{text.index('zeb@') + 12}" in spans[100 + i]
    assert all("term" not in spans[200 + i] for i in range(5))
    assert all(spans[i] == "" for i in range(60))
    clean = {r.doc_id: r.text for r in privacy.sanitise(docs(spark, rows)).collect()}
    assert clean[5] == rows[5][1]
    assert "Zebulon" not in clean[101] and "[EMAIL]" in clean[101] and "zeb@" not in clean[101]
    assert clean[200] == "the same copy of Unusual text with [EMAIL] in it"


def test_the_main_path_runs_no_python(spark):
    for plan in (privacy.report(docs(spark)), fingerprints.with_edits(docs(spark)), mixing.report(docs(spark))):
        assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())
