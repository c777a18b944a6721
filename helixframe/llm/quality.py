"""Quality rules: counts of words, symbols, repeated lines and windows, and a perplexity band per language.

The language model is an interpolated modified Kneser-Ney model over character 4-grams, one for each
language. Spark counts the grams of all documents (tasks add up their own first) and works out
continuation counts, discounts and contexts with aggregates; probabilities follow from them where a text
is scored. The model is held in hash arrays: an odd multiple of the packed code points modulo 2^64,
sorted, and found by its leading bits.

Every gram of every language is in the arrays. They are dealt by the gram into as many pieces as keep each
order of a piece near MAX_GRAMS grams; the driver gathers and broadcasts one piece after the other. With
several pieces a task loads them one by one for each batch, so memory stays bounded and only time grows.

Texts that are equal within a language count once in the model, whatever ids they have. The band judges a document by
counts without its own (held-out), so without those of all its copies: its grams leave the counts of every
order, and a gram that no other text has leaves the continuation counts below it; discounts and the number
of characters stay those of all texts. A gram counts MOST_SURPRISE
at most, so that a key or a name in another script does not decide, and noise all through does.

A language's band holds the held-out values within SPREAD quartile ranges of its quartiles,
over all of its documents of at least MIN_WORDS words; below it lies repetitive text, above it noise.
Quartiles come from counts of values rounded to STEP_DIGITS, so they are the same however rows are dealt out. A
quartile range counts as LEAST_SHARE of the mean range of all documents at least, for languages of a few alike texts.
A text of n characters strays further from its language the shorter it is, so its band is wider by the
square root of 1 + EVEN_CHARS / n. Verdicts depend on how values lie, not on how many there are: the same rows
several times over get the same verdicts.

Defined results: a null or empty text has no words and fails the base rules; a null language is a
language of its own; repeated rows are judged one by one; an empty table gives an empty table. Characters beyond U+FFFF are
folded to sixteen bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.common import cut, documents, small_batches, tasks_for

ORDER = 4
BITS = 16
MIN_WORDS = 20
STEP_DIGITS = 3
LEAST_SHARE = 0.5
# Chosen by labels of sf0.1, sf0.01 and check_s; README has the shares on these and on labels not looked at.
SPREAD = 1.5
EVEN_CHARS = 3000
MOST_SURPRISE = 4.0
MAX_GRAMS = 4_000_000
#: Up to so many languages the table of their bands is broadcast (four numbers each).
BROADCAST_LANGUAGES = 10_000
#: Up to so many hashes of repeated texts are broadcast (8 bytes each); beyond, texts are shuffled to meet them.
BROADCAST_HASHES = 2_000_000
#: Grams that a task should have at least in the steps of the model.
GRAMS_A_TASK = 50_000
# Symbols that count, and white space.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Stands before a text, ORDER - 1 times.
START = 2


# --- base rules --------------------------------------------------------------------------------

WINDOW = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight words that occur twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        h = (h ^ (h >> np.uint64(29))) * _STEP + ids[i : i + n]
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.isin(h, twice))
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()  # bytes.split() cuts at ASCII white space only
    chars = len(text) - sum(map(text.count, SPACES))
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif line.strip(SPACES):
            seen.add(line)
    return len(words), chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words)


# --- grams -------------------------------------------------------------------------------------


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams that end in each character of the texts, and the index of the text of each."""
    pad = chr(START) * (ORDER - 1)
    points = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    points = np.where(points > 0xFFFF, 0xE000 + points % np.uint64(0x1900), points)
    code = points[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        code |= points[ORDER - 1 - back : len(points) - back] << np.uint64(BITS * back)
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes + ORDER - 1) - sizes - (ORDER - 1)  # of each text in code, which has no leading pad
    return code[np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(owner))], owner


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[start], np.add.reduceat(n, start)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(lang, text), each once; empty ones are left out. Only texts whose hash repeats are shuffled, once a task each."""
    rows = docs.select("lang", "text", F.xxhash64("lang", "text").alias("hash")).where("text <> ''")
    often = cut(rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    side = F.broadcast(often) if often.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES else often
    several = rows.join(side, "hash", "left_semi").select("lang", "text").distinct()
    return rows.join(side, "hash", "left_anti").select("lang", "text").unionByName(several)


def count_grams(docs: DataFrame, held: int = 2_000_000) -> DataFrame:
    """(lang, gram, n) over all distinct texts of each language. A task adds up its own, and passes them on at `held` entries a language."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict = {}

        def out(lang, codes, counts) -> pa.RecordBatch:
            code, n = _added(codes, counts)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for b in batches:
            by: dict = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                if text:
                    by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                code, n = np.unique(grams(texts)[0], return_counts=True)
                codes, counts = own.setdefault(lang, ([], []))
                codes.append(code)
                counts.append(n)
                if sum(map(len, codes)) > held:
                    code, n = _added(codes, counts)
                    own[lang] = ([code], [n])
                    if len(code) > held // 2:
                        yield out(lang, [code], [n])
                        del own[lang]
        for lang, (codes, counts) in own.items():
            yield out(lang, codes, counts)

    return distinct_texts(docs).mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- the model ---------------------------------------------------------------------------------


def _discounts(counts: DataFrame) -> DataFrame:
    """D1, D2 and D3 of each language from the numbers of grams seen one to four times."""
    ns = counts.groupBy("lang").agg(*[F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    d = [F.lit(k) - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
    return ns.select("lang", *[F.when((F.col("n1") > 0) & (x > 0) & (x < k), x).otherwise(k / 2).alias(f"d{k}") for k, x in zip((1, 2, 3), d, strict=True)])


def continuation_counts(counts: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """By order 1 to ORDER: (lang, gram, n), and (lang, gram, total, once, twice, more): the context, the sum of n and the numbers of grams by n after it."""
    counts = cut(counts)
    tasks = tasks_for(counts.count(), GRAMS_A_TASK)
    by_order = {ORDER: counts.coalesce(tasks)}
    for k in range(ORDER - 1, 0, -1):
        by_order[k] = cut(by_order[k + 1].select("lang", F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n")).coalesce(tasks))
    n = F.col("n")
    by_n = [F.sum(n).alias("total"), F.count_if(n == 1).alias("once"), F.count_if(n == 2).alias("twice"), F.count_if(n > 2).alias("more")]
    contexts = {k: t.groupBy("lang", F.shiftrightunsigned("gram", BITS).alias("gram")).agg(*by_n).coalesce(tasks) for k, t in by_order.items()}
    return by_order, contexts


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class HashArray:
    """Values by key: hashes sorted, with the first place of each value of their leading bits."""

    hashes: np.ndarray
    values: np.ndarray
    shift: np.uint64 = field(init=False)
    first: np.ndarray = field(init=False)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        h = keys.astype(np.uint64) * _MULTIPLIER
        order = np.argsort(h)
        self.hashes, self.values = h[order], values[order]
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN where a key is missing."""
        h = keys * _MULTIPLIER
        bucket = (h >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.full((len(keys), *self.values.shape[1:]), np.nan)
        open_ = np.arange(len(keys))
        while len(open_):
            open_ = open_[at[open_] < end[open_]]
            hit = self.hashes[at[open_]] == h[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit]
            at[open_] += 1
        return out


def _groups(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted ids: the first place of each value, and the number of the value at each place."""
    new = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1


@dataclass
class Grams:
    """The grams of some texts by order: each once a text, sorted by text and gram.

    `suffix` is the place of a gram's suffix in the next lower order; `context` numbers the entries of `contexts`.
    """

    texts: int
    codes: dict[int, np.ndarray] = field(default_factory=dict)
    suffix: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    context: dict[int, np.ndarray] = field(default_factory=dict)
    times: np.ndarray = field(init=False)
    owner: np.ndarray = field(init=False)

    def __init__(self, code: np.ndarray, owner: np.ndarray, texts: int):
        """From the grams of texts, at most 2^BITS of them, one text after the other."""
        self.texts, self.codes, self.suffix, self.contexts, self.context = texts, {}, {}, {}, {}
        code, edge = code.copy(), np.searchsorted(owner, np.arange(texts + 1))
        for i in range(texts):
            code[edge[i] : edge[i + 1]].sort()
        first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])]))
        self.times = np.diff(np.append(first, len(code)))
        code, owner = code[first], owner[first].astype(np.uint64)
        self.owner = owner.astype(np.int64)
        for k in range(ORDER, 0, -1):
            self.codes[k], above = code, code >> np.uint64(BITS)
            at, self.context[k] = _groups((owner << np.uint64(BITS * (ORDER - 1))) | above)
            self.contexts[k] = above[at]
            if k > 1:
                key = (owner << np.uint64(BITS * (ORDER - 1))) | (code & np.uint64((1 << BITS * (k - 1)) - 1))
                order = np.argsort(key)
                key = key[order]
                at, number = _groups(key)
                self.suffix[k] = np.empty_like(number)
                self.suffix[k][order] = number
                code, owner = key[at] & np.uint64((1 << BITS * (ORDER - 1)) - 1), key[at] >> np.uint64(BITS * (ORDER - 1))


@dataclass
class Models:
    """The counts of all languages in broadcast pieces; `facts` has the discounts by order and the number of characters of each language."""

    pieces: list
    facts: dict

    def __getitem__(self, lang: str | None) -> CharModel:
        return CharModel(self, lang)

    def found(self, asked: list[tuple]) -> list[np.ndarray]:
        """Values for each (lang, kind, order, keys), 0 where a key is missing; a piece is loaded once for all."""
        widths = {"grams": (), "contexts": (4,)}
        out = [np.zeros((len(keys), *widths[kind])) for _, kind, _, keys in asked]
        for i, piece in enumerate(self.pieces):
            arrays = piece.value
            for (lang, kind, k, keys), values in zip(asked, out, strict=True):
                if (lang, kind, k) in arrays:
                    here = np.flatnonzero(keys.view(np.int64) % len(self.pieces) == i) if len(self.pieces) > 1 else slice(None)
                    values[here] = np.nan_to_num(arrays[lang, kind, k].find(keys[here]))
            if len(self.pieces) > 1 and getattr(piece, "_path", None):
                vars(piece).pop("_value", None)  # makes room for the next one
        return out

    def log_p(self, asked: list[tuple[str | None, Grams]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Log probability of each gram of the highest order, for grams in a language each: by all counts, and without those of the gram's own text."""
        wanted = [(lang, kind, k, keys[k]) for lang, g in asked for kind, keys in (("grams", g.codes), ("contexts", g.contexts)) for k in range(1, ORDER + 1)]
        found = self.found(wanted)
        out = []
        for i, (lang, g) in enumerate(asked):
            own = found[2 * ORDER * i : 2 * ORDER * (i + 1)]
            n, contexts = dict(enumerate(own[:ORDER], 1)), dict(enumerate(own[ORDER:], 1))
            out.append((np.log(self._chain(lang, g, n, contexts)), np.log(self._chain(lang, g, *self._without_own(g, n, contexts)))))
        return out

    def _without_own(self, g: Grams, n: dict, contexts: dict) -> tuple[dict, dict]:
        """n and contexts as they are without the text that a gram is of. A gram that only this text has takes one from the continuations of its suffix."""
        own, left, left_contexts = g.times, {}, {}
        for k in range(ORDER, 0, -1):
            left[k] = np.maximum(n[k] - own, 0)
            change = np.zeros_like(contexts[k])
            change[:, 0] = np.bincount(g.context[k], left[k] - n[k], len(change))
            for i, (was, now) in enumerate(((n[k] == 1, left[k] == 1), (n[k] == 2, left[k] == 2), (n[k] > 2, left[k] > 2)), 1):
                change[:, i] = np.bincount(g.context[k], now.astype(float) - was, len(change))
            left_contexts[k] = np.maximum(contexts[k] + change, 0)
            if k > 1:
                own = np.bincount(g.suffix[k], (n[k] > 0) & (left[k] == 0), len(n[k - 1]))
        return left, left_contexts

    def _chain(self, lang: str | None, g: Grams, n: dict, contexts: dict) -> np.ndarray:
        """Probabilities of the highest order, by the interpolation of all orders; what was never seen has the share that its context leaves."""
        discounts, characters = self.facts[lang]
        below = np.where(n[1] > 0, 1 / characters, 1 / (1 << BITS))
        for k in range(1, ORDER + 1):
            d = np.array([0, *discounts[k]])
            total, mass = contexts[k][:, 0], contexts[k][:, 1:] @ d[1:]
            share = np.maximum(total, 1)
            p = (n[k] - d[np.minimum(n[k], 3).astype(int)]) / share[g.context[k]] + np.where(total > 0, mass / share, 1.0)[g.context[k]] * (below if k == 1 else below[g.suffix[k]])
            below = p
        return below


@dataclass
class CharModel:
    """The model of one language."""

    models: Models
    lang: str | None

    def log_p(self, code: np.ndarray) -> np.ndarray:
        """Log probability of each gram; unseen ones weigh the next lower order."""
        codes, at = np.unique(code, return_inverse=True)
        return self.models.log_p([(self.lang, Grams(codes, np.zeros(len(codes), np.int64), 1))])[0][0][at]


def model_arrays(counts: DataFrame, max_grams: int = MAX_GRAMS) -> Models:
    """The models of all languages, with every gram: in pieces of about max_grams grams and contexts of each order. The driver holds one piece at a time."""
    by_order, contexts = continuation_counts(counts)
    pieces = max(tasks_for(t.count(), max_grams) for t in by_order.values())
    pieces += pieces % 2 == 0  # an odd number, so that all characters of a gram count
    facts: dict = {}
    for k, t in by_order.items():
        for r in _discounts(t).collect():
            facts.setdefault(r.lang, [{}, 0])[0][k] = (r.d1, r.d2, r.d3)
    for r in by_order[1].groupBy("lang").count().collect():
        facts[r["lang"]][1] = r["count"]
    sent = [("grams", k, t, ["n"]) for k, t in by_order.items()]
    sent += [("contexts", k, cut(t) if pieces > 1 else t, ["total", "once", "twice", "more"]) for k, t in contexts.items()]
    shared = []
    for i in range(pieces):
        arrays = {}
        for kind, k, table, names in sent:
            own = table.where(F.pmod("gram", F.lit(pieces)) == i) if pieces > 1 else table
            got = own.select("lang", "gram", *[F.col(x).cast("double") for x in names]).toArrow()
            for lang in got.column("lang").unique().to_pylist():
                rows = got.filter(pc.is_null(got.column("lang")) if lang is None else pc.equal(got.column("lang"), lang))
                values = [rows.column(x).to_numpy() for x in names]
                arrays[lang, kind, k] = HashArray(rows.column("gram").to_numpy().view(np.uint64), values[0] if len(values) == 1 else np.column_stack(values))
        shared.append(counts.sparkSession.sparkContext.broadcast(arrays))
    return Models(shared, facts)


# --- scores and verdicts -----------------------------------------------------------------------

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def scored(docs: DataFrame, models: Models) -> DataFrame:
    """The row of each document as a struct, with its counts, log perplexity and held-out log perplexity (both null without characters)."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "lang", "text")
    schema = rows.select("row").schema
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("log_perplexity", "double").add("log_held_out", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            langs = b.column("lang").to_pylist()
            base = np.array([base_counts(t) for t in texts], np.int64).reshape(len(texts), len(COUNTS))
            perplexity, held_out = np.full((2, len(texts)), np.nan)
            asked, places = [], []
            for lang in set(langs):
                own = [i for i, x in enumerate(langs) if x == lang and texts[i]]
                if own and lang in models.facts:
                    asked.append((lang, Grams(*grams([texts[i] for i in own]), len(own))))
                    places.append(own)
            for (_, g), own, both in zip(asked, places, models.log_p(asked), strict=True):
                sizes = np.array([len(texts[i]) for i in own])
                perplexity[own], held_out[own] = (-np.bincount(g.owner, g.times * log_p, g.texts) / sizes for log_p in (both[0], np.maximum(both[1], -MOST_SURPRISE)))
            yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(base[:, i]) for i in range(len(COUNTS))), pa.array(perplexity, from_pandas=True), pa.array(held_out, from_pandas=True)], names=["row", *COUNTS, "log_perplexity", "log_held_out"])

    return rows.mapInArrow(score, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def bands(scores: DataFrame, spread: float = SPREAD) -> DataFrame:
    """(band_lang, low, high, width) from (lang, n_words, log_held_out) of all documents: quartiles, and how far beyond them a long text may lie. One row for each language."""
    values = scores.where((F.col("n_words") >= MIN_WORDS) & F.col("log_held_out").isNotNull()).groupBy(F.col("lang").alias("band_lang"), F.round("log_held_out", STEP_DIGITS).alias("value")).agg(F.count("*").alias("n"))
    # a few thousand values for each language
    by = Window.partitionBy("band_lang")
    ranked = values.withColumns({"upto": F.sum("n").over(by.orderBy("value")), "documents": F.sum("n").over(by)})
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("documents"), F.col("value")))
    found = cut(ranked.groupBy("band_lang", "documents").agg(at(0.25).alias("low"), at(0.75).alias("high")))
    wide, m = F.col("high") - F.col("low"), F.col("documents")
    pooled = found.agg((F.sum(wide * m) / F.sum(m)).alias("pooled"))
    width = F.greatest(wide, F.lit(LEAST_SHARE) * F.col("pooled")) * F.lit(spread)
    return found.crossJoin(F.broadcast(pooled)).select("band_lang", "low", "high", width.alias("width"))


def verdicts(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Add base_failed and kept to rows with lang, counts and log_held_out."""
    # a shuffle by language would put all texts of one into one task
    few = limits.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES
    joined = rows.join(F.broadcast(limits) if few else limits, F.col("lang").eqNullSafe(F.col("band_lang")), "left").withColumn("base_failed", base_failed())
    width = F.col("width") * F.sqrt(1 + F.lit(float(EVEN_CHARS)) / F.greatest(F.lit(1), F.col("word_chars")))
    inside = F.coalesce(F.col("log_held_out").between(F.col("low") - width, F.col("high") + width), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & inside).drop("band_lang", "low", "high", "width")


def quality_scores(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the counts, log_perplexity, log_held_out, base_failed, kept: one row per document."""
    models = model_arrays(count_grams(docs))
    scores = cut(scored(docs.select("doc_id", "lang", "text"), models).select("row.doc_id", "row.lang", *COUNTS, "log_perplexity", "log_held_out"))
    return verdicts(scores, cut(bands(scores)))


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their own columns."""
    models = model_arrays(count_grams(docs))
    rows = cut(scored(docs, models))  # texts are scored once; the bands need all scores
    limits = cut(bands(rows.select("row.lang", "n_words", "log_held_out")))
    return verdicts(rows.withColumn("lang", F.col("row.lang")), limits).where("kept").select("row.*")


def op8_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir)).select("doc_id", *COUNTS, "base_failed", "kept", F.exp("log_perplexity").alias("perplexity"), F.exp("log_held_out").alias("held_out_perplexity"))


QUERIES = {"op8_quality_perplexity": op8_quality_perplexity}
