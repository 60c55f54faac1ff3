"""Language of each word and document by a linear-chain conditional random field.

A word scores for every language by its affixes, its letter n-grams and as a whole (the
lexicon). Learned transitions tie the words of a text together, so that code-switched texts
fall into runs. Forward-backward gives the probability of each language at each word; a
document's language has the largest mean.

These probabilities compare the known languages only. Whether a text is in any of them is told
by its letters: how likely they are in the language of each word, against what is usual in
texts of that language that were kept aside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from hazardlens.llm.common import CHUNK, add_columns_by_chunk

#: Training reads at most so many documents of a language and of all languages together (every
#: language has ten of these at least), of each at most so many consecutive code points from a
#: place that the id's hash picks.
SAMPLE_DOCS, SAMPLE_ALL, SAMPLE_CHARS = 400, 60_000, 1_500
#: Training sequences of a language, and how many are worked on at a time, in probabilities.
SEQUENCES, BATCH = 625, 800_000
ROUNDS, STEP, RIDGE = 40, 0.15, 1e-4
#: Words of a piece, pieces of a sequence.
PIECE, PIECES = 8, 3
#: Every fifth text of a language is kept aside to see how likely the letters of others are.
ASIDE = 5
#: Letters are unusual if their likelihood lies so far below the usual one (natural logarithm), or
#: below four times what one in a hundred of the texts kept aside has, if that is more; a text's
#: mean is taken to be so many standard errors higher than it is.
UNUSUAL, SURE = 3.0, 3.0
_BITS = 14
_LEXICON_BITS = 16
#: Characters of texts that are worked on at a time, with few languages; bounds memory only.
CHARS = CHUNK // 4
#: Words that are chained side by side; with many languages whole texts are.
_BLOCK, _FEW = 32, 16
_SIZE = 3 * (1 << _BITS) + (1 << _LEXICON_BITS)


def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_IS_LETTER: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    if not _IS_LETTER:
        _IS_LETTER.append(_letters())
    return _IS_LETTER[0]


def _bucket(x: np.ndarray, bits: int) -> np.ndarray:
    """Hashes of 64-bit values in ``bits`` bits."""
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def word_features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places where words start, n-gram features per letter, where each word's features
    start, and the lexicon feature per word. A word is a run of letters, lower-cased."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    own = np.zeros(len(code) + 4, np.uint64)
    own[2:-2] = np.where(is_letter()[code], code, 0)
    letter = own > 0
    at = np.flatnonzero(letter)
    starts = letter[at - 1] == 0 if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(starts)
    two, three = own[at] | own[at + 1] << np.uint64(21), own[at - 1]
    near = two | three << np.uint64(42)
    beyond = np.where(own[at + 1] > 0, own[at + 2], np.uint64(0))
    four = near ^ beyond * np.uint64(0xD6E8FEB86659FD93)
    size = 1 << _BITS
    grams = np.stack([_bucket(two, _BITS), _bucket(near, _BITS) + size, _bucket(four, _BITS) + 2 * size])
    # The whole word: a sum of its letters, each scrambled with its place in the word.
    place = (np.arange(len(at)) - np.repeat(first, np.diff([*first, len(at)]))).astype(np.uint64)
    mixed = (own[at] + (place << np.uint64(21))) * np.uint64(0xA0761D6478BD642F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xE7037ED1A0B428DB)
    whole = np.add.reduceat(mixed, first) if len(first) else mixed
    lexicon = _bucket(whole ^ whole >> np.uint64(31), _LEXICON_BITS) + 3 * size
    return at[first] - 2, grams, first, lexicon


@dataclass
class Model:
    """``weights`` by feature and language, ``transitions`` and ``first`` as scores; ``letters``,
    the logarithm of how likely a letter and its neighbours are by language, ``usual``, its middle
    over words and their deviation, and ``limit``, below which letters are those of no language."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    first: np.ndarray
    letters: np.ndarray | None = None
    usual: np.ndarray | None = None
    limit: float = 0.0

    def emissions(self, grams: np.ndarray, first: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.zeros((0, len(self.languages)))
        summed = self.weights[grams[0]] + self.weights[grams[1]] + self.weights[grams[2]]
        return np.add.reduceat(summed, first, axis=0, dtype=np.float64) + self.weights[lexicon]

    def marginals(self, scores: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probability of each language at each word; ``starts`` marks first words of texts."""
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        t = np.exp(self.transitions - self.transitions.max())
        pi = np.exp(self.first - self.first.max())
        last = np.append(starts[1:], True)
        n = len(e)
        out = _scan(starts, len(pi), lambda p, i: (p @ t) * e[i][:, None], lambda i: pi * e[i])
        # From the ends: the word after place n - 1 - i is e[n - i].
        out *= _scan(last[::-1], len(pi), lambda p, i: (p * e[n - i][:, None]) @ t.T, lambda i: np.ones((len(i), len(pi))))[::-1]
        out /= out.sum(axis=1, keepdims=True)
        return out

    def letter_scores(self, grams: np.ndarray, first: np.ndarray, language: np.ndarray) -> np.ndarray:
        """How likely the letters of each word are in its ``language``: the mean logarithm."""
        size = np.diff([*first, grams.shape[1]])
        own = self.letters[grams[1] - (1 << _BITS), np.repeat(language, size)]
        return np.add.reduceat(own, first, dtype=np.float64) / size


def _scan(reset: np.ndarray, width: int, step, restart) -> np.ndarray:
    """Vectors of chains that each follow from the one before by a linear ``step``, except where
    a chain starts anew; scaled to a largest entry of 1.

    Chains go side by side. With few languages long ones are cut into lanes: first the matrix of
    each lane as a whole is multiplied, then a chain's lanes are linked, and last the
    vectors are carried through all of them. Memory is a few vectors a word.
    """
    n = len(reset)
    starts = np.flatnonzero(reset)
    sizes = np.diff(np.append(starts, n))
    if width <= _FEW:
        lanes = -(-sizes // _BLOCK)
        chain = np.repeat(np.arange(len(starts)), lanes)
        number = np.arange(len(chain)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = starts[chain] + number * _BLOCK
        size = np.minimum(_BLOCK, sizes[chain] - number * _BLOCK)
    else:
        first, size, number = starts, sizes, np.zeros(len(starts), np.int64)
    vector = np.empty((len(first), width))
    vector[number == 0] = restart(first[number == 0])
    later = np.flatnonzero(number)
    if len(later):
        # What a lane makes of the vector before it. The last lane of a chain is not needed.
        inner = np.flatnonzero((number > 0) & np.append(number[1:] > 0, False))
        whole = {}
        if len(inner):
            p = np.broadcast_to(np.eye(width), (len(inner), width, width))
            for j in range(_BLOCK):
                p = step(p, first[inner] + j)
                p = p / p.max(axis=(1, 2), keepdims=True)
            whole = dict(zip(inner.tolist(), p, strict=True))
        heads = np.flatnonzero((number == 0) & np.append(number[1:] > 0, False))
        ends = vector[heads][:, None]
        for j in range(1, _BLOCK):
            ends = step(ends, first[heads] + j)
            ends = ends / ends.max(axis=2, keepdims=True)
        end = dict(zip(heads.tolist(), ends[:, 0], strict=True))
        for lane in later.tolist():
            before = end[lane - 1]
            vector[lane] = before
            if lane in whole:
                after = before @ whole[lane]
                end[lane] = after / after.max()
    out = np.empty((n, width))
    by_size = np.argsort(-size, kind="stable")
    first, size, fresh, now = first[by_size], size[by_size], number[by_size] == 0, vector[by_size][:, None]
    for j in range(int(size[0]) if n else 0):
        live = int(np.searchsorted(-size, -j, "left"))
        i, now = first[:live] + j, now[:live]
        if j:
            now = step(now, i)
        else:
            now[~fresh] = step(now[~fresh], i[~fresh])
        now = now / now.max(axis=2, keepdims=True)
        out[i] = now[:, 0]
    return out


@dataclass
class _Words:
    """Words of several texts by number: their features, and the words of each text."""

    grams: np.ndarray
    first: np.ndarray
    lexicon: np.ndarray
    texts: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str]) -> _Words:
        grams, lexicon, sizes, own, at = [np.zeros((3, 0), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
        for text in texts:
            _, g, first, lex = word_features(text.lower())
            grams.append(g)
            lexicon.append(lex)
            sizes.append(np.diff([*first, g.shape[1]]) if len(first) else np.zeros(0, np.int64))
            own.append(np.arange(at, at + len(first)))
            at += len(first)
        size = np.concatenate(sizes)
        return cls(np.hstack(grams), np.cumsum(size) - size, np.concatenate(lexicon), own)

    def take(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, where those of each word start, and lexicon features of some words."""
        size = np.diff(np.append(self.first, self.grams.shape[1]))[words]
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(first, size) + np.repeat(self.first[words], size)
        return self.grams[:, at], first, self.lexicon[words]


def sequences(texts: list[np.ndarray], labels: list[int], count: int, each: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Words and labels of training sequences, -1 beyond their ends.

    Texts are cut into pieces of up to ``PIECE`` words, so that texts of any length are learned.
    Each language that has a word begins ``each`` sequences of three pieces; the next piece
    changes language half the time, so that code-switched text is learned as well.
    """
    by: list[list[np.ndarray]] = [[] for _ in range(count)]
    for own, label in zip(texts, labels, strict=True):
        by[label] += [own[i : i + PIECE] for i in range(0, len(own), PIECE)]
    known = [k for k in range(count) if by[k]]
    words = np.full((each * len(known), PIECE * PIECES), -1)
    truth = words.copy()
    for row in range(len(words)):
        now, at = known[row % len(known)], 0
        for _ in range(PIECES):
            piece = by[now][rng.integers(len(by[now]))]
            words[row, at : at + len(piece)], truth[row, at : at + len(piece)] = piece, now
            at += len(piece)
            if rng.random() < 0.5:
                now = known[rng.integers(len(known))]
    return words, truth


def gradient(model: Model, words: _Words, rows: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
    """Gradient of the mean log-likelihood of sequences: weights, transitions, first."""
    count, held = len(model.languages), rows >= 0
    used, where = np.unique(rows[held], return_inverse=True)
    grams, first, lexicon = words.take(used)
    scores = np.zeros((*rows.shape, count))
    scores[held] = model.emissions(grams, first, lexicon)[where]
    gamma, expected = _expectations(scores, held, model.transitions, model.first)
    both = held[:, 1:]
    pairs = np.zeros((count, count))
    np.add.at(pairs, (truth[:, :-1][both], truth[:, 1:][both]), 1)
    wrong = -gamma
    wrong[held, truth[held]] += 1
    wrong /= len(rows)
    by_word = np.stack([np.bincount(where, f, len(used)) for f in wrong[held].T], axis=1)
    spread = np.repeat(by_word, np.diff(np.append(first, grams.shape[1])), axis=0)
    out = np.zeros(model.weights.shape)
    for k in range(count):
        for g in grams:
            out[:, k] += np.bincount(g, spread[:, k], _SIZE)
        out[:, k] += np.bincount(lexicon, by_word[:, k], _SIZE)
    return [out, (pairs - expected) / len(rows), wrong[:, 0].sum(axis=0)]


def train(texts: list[str], labels: list[str], seed: int = 7, each: int = SEQUENCES) -> Model:
    """Fit the field to texts of known languages by gradient ascent on its likelihood, with
    ``each`` sequences of each language, and the letters of each language to what is kept aside.

    Work and memory grow with the number of languages; sequences are taken by batches.
    """
    languages = sorted(set(labels))
    count, rng = len(languages), np.random.default_rng(seed)
    model = Model(languages, np.zeros((_SIZE, count), np.float32), np.zeros((count, count)), np.zeros(count))
    words = _Words.of(texts)
    label = [languages.index(x) for x in labels]
    rows, truth = sequences(words.texts, label, count, each, rng)
    if not len(rows):
        return model
    batches = -(-rows.size * count // BATCH)
    theta = [model.weights, model.transitions, model.first]
    mean = [np.zeros(x.shape, np.float32) for x in theta]
    square = [np.zeros(x.shape, np.float32) for x in theta]
    for r in range(1, max(ROUNDS, 2 * batches) + 1):
        own = slice((r - 1) % batches, None, batches)
        for x, g, m, q in zip(theta, gradient(model, words, rows[own], truth[own]), mean, square, strict=True):
            s = g - RIDGE * x
            m *= 0.9
            m += 0.1 * s
            q *= 0.99
            q += 0.01 * s * s
            scale = STEP * np.sqrt(1 - 0.99**r) / (1 - 0.9**r)
            x += scale * m / (np.sqrt(q) + 1e-8)
    _fit_letters(model, words, label)
    return model


def _fit_letters(model: Model, words: _Words, label: list[int]) -> None:
    """Likelihoods of letters by language, and what is usual in texts that are kept aside; a
    language with fewer than ``ASIDE`` texts is judged by those it learned from, more loosely."""
    count = len(model.languages)
    counts = np.zeros((1 << _BITS, count), np.float32)
    seen, aside = np.zeros(count, np.int64), []
    for own, k in zip(words.texts, label, strict=True):
        if not len(own):
            continue
        seen[k] += 1
        if seen[k] % ASIDE:
            counts[:, k] += np.bincount(words.take(own)[0][1] - (1 << _BITS), minlength=1 << _BITS)
        else:
            aside.append((own, k))
    few = set(np.flatnonzero(seen < ASIDE).tolist())
    aside += [(own, k) for own, k in zip(words.texts, label, strict=True) if k in few and len(own)]
    model.letters = np.log((counts + 0.05) / (counts.sum(axis=0) + 0.05 * (1 << _BITS))).astype(np.float32)
    model.usual = np.tile(np.array([0.0, 1.0]), (count, 1))
    by: list[list[np.ndarray]] = [[] for _ in range(count)]
    for own, k in aside:
        grams, first, _ = words.take(own)
        by[k].append(model.letter_scores(grams, first, np.full(len(own), k)))
    low = []
    for k in range(count):
        if by[k]:
            every = np.concatenate(by[k])
            model.usual[k] = np.median(every), max(0.2, every.std()) * (2 if k in few else 1)
            low += [s.mean() - model.usual[k, 0] + SURE * model.usual[k, 1] / len(s) ** 0.5 for s in by[k]]
    if low:
        model.limit = min(-UNUSUAL, 4 * float(np.quantile(low, 0.01)))


def _expectations(e, held, transitions, first) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of sequences, zero beyond their ends, and the expected transitions of all."""
    x = np.exp(e - e.max(axis=2, keepdims=True))
    t, length = np.exp(transitions - transitions.max()), e.shape[1]
    alpha, beta = np.empty(x.shape), np.ones(x.shape)
    alpha[:, 0] = np.exp(first - first.max()) * x[:, 0]
    for j in range(1, length):
        alpha[:, j] = (alpha[:, j - 1] @ t) * x[:, j]
        alpha[:, j] /= alpha[:, j].max(axis=1, keepdims=True)
    for j in range(length - 2, -1, -1):
        on = held[:, j + 1]
        beta[on, j] = (beta[on, j + 1] * x[on, j + 1]) @ t.T
        beta[:, j] /= beta[:, j].max(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    gamma[~held] = 0
    expected = np.zeros(t.shape)
    for j in range(length - 1):
        on = held[:, j + 1]
        ahead = x[on, j + 1] * beta[on, j + 1]
        total = ((alpha[on, j] @ t) * ahead).sum(axis=1, keepdims=True)
        expected += (alpha[on, j] / total).T @ ahead * t
    return gamma, expected


def shares(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Mean probability of each language over the words of each text, zeros without words; and how
    far the likelihood of its letters is from usual, as the upper bound of a mean logarithm."""
    lowered = [(t or "").lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    at, grams, first, lexicon = word_features("\n".join(lowered))
    out, usual = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    if not len(at) or not model.languages:
        return out, usual
    owner = np.searchsorted(ends, at, "right")
    starts = np.append(True, owner[1:] != owner[:-1])
    gamma = model.marginals(model.emissions(grams, first, lexicon), starts)
    firsts = np.flatnonzero(starts)
    words = np.diff([*firsts, len(at)])
    out[owner[firsts]] = np.add.reduceat(gamma, firsts, axis=0) / words[:, None]
    if model.letters is not None:
        language = gamma.argmax(axis=1)
        middle, spread = model.usual[language].T
        off = np.add.reduceat(model.letter_scores(grams, first, language) - middle, firsts) / words
        usual[owner[firsts]] = off + SURE * np.sqrt(np.add.reduceat(spread**2, firsts)) / words
    return out, usual
    owner = np.searchsorted(ends, at, "right")
    starts = np.append(True, owner[1:] != owner[:-1])
    gamma = model.marginals(model.emissions(grams, first, lexicon), starts)
    firsts = np.flatnonzero(starts)
    words = np.diff([*firsts, len(at)])
    out[owner[firsts]] = np.add.reduceat(gamma, firsts, axis=0) / words[:, None]
    if model.letters is not None:
        language = gamma.argmax(axis=1)
        middle, spread, lasting = model.usual[language].T
        off = np.add.reduceat(model.letter_scores(grams, first, language) - middle, firsts) / words
        noise = np.add.reduceat(spread**2, firsts) / words**2 + np.add.reduceat(lasting**2, firsts) / words
        usual[owner[firsts]] = off / np.sqrt(noise)
    return out, usual


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learn(
    docs: DataFrame,
    per_language: int = SAMPLE_DOCS,
    chars: int = SAMPLE_CHARS,
    in_all: int = SAMPLE_ALL,
    each: int = SEQUENCES,
) -> Model:
    """A model of all values of ``lang``, from a bounded sample of documents not held out.

    Rows with a null doc_id, text or lang are not learned from. The sample is the same for
    the same rows: those with the smallest MD5 of their id. Rows that repeat count as often as they
    stand there. A table without such rows gives a model of no language.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    ).select("doc_id", "lang", "text")
    # As many rows as the model has languages.
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    per_language = max(10, min(per_language, in_all // max(1, len(sizes))))
    counts = docs.sparkSession.createDataFrame([(r["lang"], r["n"]) for r in sizes], "lang string, n long")
    # Only ids whose hash is small enough compete, a few times as many as are taken, so no
    # task gathers a language, however many tasks read it.
    hashed = F.md5(F.col("doc_id").cast("string"))
    share = F.conv(F.substring(hashed, 1, 12), 16, 10).cast("double") / float(1 << 48)
    known = known.join(F.broadcast(counts), "lang").where(share <= (4.0 * per_language) / F.col("n"))
    room = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("doc_id"), room.cast("long")).cast("int") + 1
    sample = known.select(
        "lang", hashed.alias("h"), F.substring("text", start, F.lit(chars)).alias("text")
    )
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = sample.withColumn("_rn", order).where(F.col("_rn") <= per_language)
    rows = sorted((r.lang, r.h, r.text) for r in sample.select("lang", "h", "text").collect())
    return train([r[2] for r in rows], [r[0] for r in rows], each=each)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, its mean probability over all words, and ``usual``: how
    far the letters of the text are from what is usual in its languages, as the mean difference of
    the logarithm of their likelihood, for the short text's chance on the safe side. Below the
    ``limit`` of the model, which was fitted to texts kept aside, a text is in none of them.

    Texts that are null or have no letter get ``und``, 0 and 0; so does everything if the model
    has no language. Only the text is looked at, as a whole, however long. Ties go to the
    language that sorts first. Rows stay as they are, repeated ones too; an empty table gives no
    rows; input columns named like the results are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def call(texts: list):
            found, usual = shares(sent.value, texts)
            best = found.argmax(axis=1) if found.shape[1] else np.zeros(len(texts), np.int64)
            score = [float(min(1.0, r[b])) if len(r) else 0.0 for r, b in zip(found, best, strict=True)]
            names = [sent.value.languages[b] if s > 0 else "und" for b, s in zip(best, score, strict=True)]
            return names, score, usual.tolist()

        return call

    fields = [StructField("lang_pred", StringType(), False), StructField("score", DoubleType(), False), StructField("usual", DoubleType(), False)]
    # A word holds a few probabilities of every language at a time.
    chunk = CHARS * _FEW // max(_FEW, len(model.languages))
    return add_columns_by_chunk(docs, [text], fields, make, chunk)


def predict(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row of ``docs``, whose null
    values, repeated rows and ties are treated as ``identify`` says. Further columns are not read."""
    model = learn(docs)
    base = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(base, model).select("doc_id", "held_out", "lang_pred", "score")
