"""Language identification by interpolated Kneser-Ney models over characters.

Per order there is one sorted array of 64-bit hashes of the n-grams seen in any language, and beside
it each language's log-probability of the last character, already interpolated. A whole text is
scored with array searches; only n-grams new to all languages go to the shorter ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtables.llm.shared import in_small_batches

ORDER = 4
#: About so many labelled documents per language are learnt from, chosen by a hash of their id. The
#: only bound here: texts are read whole, and every document is scored.
ROWS_PER_LANGUAGE = 2000
#: Characters that are scored at once. A longer text is scored in stretches of this size.
STRETCH = 1 << 18
SPACE, START = 32, 0
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"
RESULT = "lang_pred string, score double, cross_entropy double, rejected boolean"


@cache
def letters() -> np.ndarray:
    """For each code point: its lower-case letter, or a space."""
    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def normalized(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts and each text's first place, plus the end of the last.

    Each text is preceded by ORDER - 1 start symbols, and runs of other characters than letters
    become one space (none at the beginning).
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    pad = ORDER - 1
    ends = np.cumsum(sizes + pad)
    codes = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
    body = np.ones(len(codes), bool)
    body[((ends - sizes - pad)[:, None] + np.arange(pad)).ravel()] = False
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    codes[body] = letters()[points]
    keep = np.ones(len(codes), bool)
    blank = codes == SPACE
    keep[1:] = ~(blank[1:] & (blank[:-1] | (codes[:-1] == START)))
    before = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], before[np.concatenate([[0], ends])]


def hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each place, for n = 1 to ORDER."""
    with np.errstate(over="ignore"):
        wide = (codes.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
        wide ^= wide >> np.uint64(29)
        out = [wide]
        for _ in range(ORDER - 1):
            longer = wide.copy()
            longer[1:] += out[-1][:-1] * np.uint64(0xD6E8FEB86659FD93)
            longer ^= longer >> np.uint64(32)
            out.append(longer)
    return out


GRAMS = [f"g{n}" for n in range(1, ORDER + 1)] + [f"c{n}" for n in range(1, ORDER)]
COUNTED = "lang string, " + ", ".join(f"{g} bigint" for g in GRAMS) + ", n bigint"


def count_grams(labelled: DataFrame) -> DataFrame:
    """Counts of the longest n-grams by language, each with the hashes of its suffixes (g) and of
    its contexts (c). Shorter n-grams are counted by their distinct extensions, from these rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                for texts in stretches(group["text"].tolist()):
                    codes, _ = normalized([t for _, t in texts])
                    found = hashes(codes)
                    at = np.flatnonzero(codes != START)
                    _, first, n = np.unique(found[-1][at], return_index=True, return_counts=True)
                    at = at[first]
                    columns = {f"g{k + 1}": found[k][at].view(np.int64) for k in range(ORDER)}
                    columns |= {f"c{k}": found[k - 1][at - 1].view(np.int64)
                                for k in range(1, ORDER)}
                    yield pd.DataFrame({"lang": lang, **columns, "n": n})

    return labelled.mapInPandas(count, COUNTED).groupBy("lang", *GRAMS).agg(F.sum("n").alias("n"))


def stretches(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """The texts with their numbers, in lists of about STRETCH characters."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for begin in range(0, max(1, len(text)), STRETCH):
            part = text[begin:begin + STRETCH]
            if held and size + len(part) > STRETCH:
                yield held
                held, size = [], 0
            held.append((i, part))
            size += len(part)
    if held:
        yield held


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in a sorted array, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    """Sorted hashes and, by language, log-probabilities (`logp`) and back-off weights (`away`)."""

    langs: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    away: list[np.ndarray] = field(default_factory=list)
    unseen: float = 0.0
    temperature: float = 1.0
    mean: np.ndarray | None = None
    limit: np.ndarray | None = None

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Negative log2-probability by text and language; characters and letters by text."""
        total = np.zeros((len(texts), len(self.langs)))
        size, letter = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for part in stretches(texts):
            codes, places = normalized([t for _, t in part])
            real = codes != START
            scored = np.zeros((len(codes) + 1, len(self.langs)))
            np.cumsum(np.where(real[:, None], self.log2(codes), 0), axis=0, out=scored[1:])
            counts = np.concatenate([[0], np.cumsum(real)])
            alpha = np.concatenate([[0], np.cumsum(real & (codes != SPACE))])
            number = [i for i, _ in part]
            np.add.at(total, number, -(scored[places[1:]] - scored[places[:-1]]))
            np.add.at(size, number, counts[places[1:]] - counts[places[:-1]])
            np.add.at(letter, number, alpha[places[1:]] - alpha[places[:-1]])
        return total, size, letter

    def log2(self, codes: np.ndarray) -> np.ndarray:
        found = hashes(codes)
        at, hit = find(self.keys[-1], found[-1])
        out = self.logp[-1][at]
        left = np.flatnonzero(~hit)
        if len(left):
            extra = np.zeros((len(left), len(self.langs)), np.float32)
            done = np.zeros(len(left), bool)
            for n in range(ORDER - 1, 0, -1):
                previous = found[n - 1][np.maximum(left - 1, 0)]
                at, seen = find(self.contexts[n - 1], previous)
                extra[~done & seen] += self.away[n - 1][at][~done & seen]
                at, hit = find(self.keys[n - 1], found[n - 1][left])
                now = hit & ~done
                extra[now] += self.logp[n - 1][at][now]
                done |= hit
            extra[~done] += self.unseen
            out[left] = extra
        return out

    def judge(self, texts: list[str]) -> pd.DataFrame:
        if not self.langs:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0,
                                 "cross_entropy": np.nan, "rejected": True})
        bits, size, letter = self.bits(texts)
        best = bits.argmin(axis=1)
        rows = np.arange(len(texts))
        with np.errstate(invalid="ignore"):
            entropy = np.where(letter > 0, bits[rows, best] / np.maximum(size, 1), np.nan)
            far = (entropy - self.mean[best]) * np.minimum(1, np.sqrt(letter / FULL))
        odds = np.exp2((bits[rows, best][:, None] - bits) / self.temperature)
        langs = np.array([*self.langs, UNKNOWN], object)
        return pd.DataFrame({
            "lang_pred": langs[np.where(letter > 0, best, len(self.langs))],
            "score": np.where(letter > 0, 1 / odds.sum(axis=1), 0.0),
            "cross_entropy": entropy,
            "rejected": (letter == 0) | (far > self.limit[best])})


#: A language with no more labelled documents is counted and calibrated with all of them.
FEW = 40
#: Letters from which on a text's cross-entropy is held against the full limit.
FULL = 200
#: The limit of rejection above the mean cross-entropy of a language: in times of what this share of
#: its labelled texts outside the counts reach, and at least this share of the way to the language's
#: own characters in random order. Texts that mix languages or carry codes and numbers stay below it.
QUANTILE, SLACK, WAY = 0.95, 1.5, 0.75
#: Characters of the labelled texts of a language that are put in random order.
SHUFFLED = 1 << 16


def fit(counts: pd.DataFrame) -> Model:
    """Interpolated Kneser-Ney from the counts; one discount per order and language."""
    model = Model(sorted(counts["lang"].unique()) if len(counts) else [])
    if not model.langs:
        return model
    column = {lang: i for i, lang in enumerate(model.langs)}
    shape = len(column)
    level = counts.assign(lang=counts["lang"].map(column))
    tables = [None] * ORDER
    for n in range(ORDER, 0, -1):
        # Below the top, the count of an n-gram is the number of characters seen before it.
        if n < ORDER:
            level = level.groupby(["lang", *GRAMS[:n], *[f"c{k}" for k in range(1, n)]],
                                  as_index=False).size().rename(columns={"size": "n"})
        tables[n - 1] = level
    lower, lower_keys = None, None
    size = tables[0][["g1"]].nunique().iloc[0] + 1
    model.unseen = float(-np.log2(size))
    for n in range(1, ORDER + 1):
        t = tables[n - 1]
        lang, gram = t["lang"].to_numpy(), t[f"g{n}"].to_numpy().view(np.uint64)
        context = t[f"c{n - 1}"].to_numpy().view(np.uint64) if n > 1 else np.zeros(
            len(t), np.uint64)
        value = t["n"].to_numpy(float)
        ones = np.bincount(lang[value == 1], minlength=shape)
        twos = np.bincount(lang[value == 2], minlength=shape)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.05, 0.95)
        contexts, which = np.unique(context, return_inverse=True)
        totals, kinds = np.zeros((len(contexts), shape)), np.zeros((len(contexts), shape))
        np.add.at(totals, (which, lang), value)
        np.add.at(kinds, (which, lang), 1)
        away = np.where(totals > 0, discount * kinds / np.maximum(totals, 1), 1.0)
        keys, place = np.unique(gram, return_inverse=True)
        own = np.zeros((len(keys), shape))
        own[place, lang] = (value - discount[lang]) / totals[which, lang]
        # Every key has one context and one suffix, whatever the language.
        of = np.zeros(len(keys), np.int64)
        of[place] = which
        if n == 1:
            base = np.full((len(keys), shape), 1 / size)
        else:
            suffix = np.zeros(len(keys), np.uint64)
            suffix[place] = t[f"g{n - 1}"].to_numpy().view(np.uint64)
            base = lower[np.searchsorted(lower_keys, suffix)]
        lower, lower_keys = own + away[of] * base, keys
        model.keys.append(keys)
        model.logp.append(np.log2(lower).astype(np.float32))
        if n == 1:
            model.unseen += float(np.log2(away[0]).max())
        else:
            model.contexts.append(contexts)
            model.away.append(np.log2(away).astype(np.float32))
    # contexts[n - 1] belongs to the (n + 1)-grams: where one is unknown, its weight leads to n.
    return model


def measured(model: Model, texts: DataFrame) -> pd.DataFrame:
    """Bits by language, characters and letters of texts (lang, few, each, text), on the executors,
    and the first `each` characters of every text."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits, size, letter = shared.value.bits(batch["text"].tolist())
            yield pd.DataFrame({
                "lang": batch["lang"], "few": batch["few"], "bits": list(bits), "size": size,
                "letter": letter,
                "head": [t[:n] for t, n in zip(batch["text"], batch["each"], strict=True)]})

    return texts.select("lang", "few", "each", "text").mapInPandas(
        measure, "lang string, few boolean, bits array<double>, size bigint, letter bigint, "
        "head string").toPandas()


def calibrate(model: Model, rest: pd.DataFrame) -> Model:
    """Temperature and limits of rejection from labelled texts, as `measured` gives them.

    Texts of a language with few of them were counted too. They are no measure for the temperature,
    unless there are no others, and what limits such a language is how far its own characters in
    random order are.
    """
    shape = len(model.langs)
    model.mean, model.limit = np.zeros(shape), np.full(shape, np.inf)
    if not model.langs:
        return model
    column = {lang: i for i, lang in enumerate(model.langs)}
    rest = rest[(rest["letter"] > 0) & rest["lang"].isin(column)]
    if not len(rest):
        return model
    bits, size = np.stack(rest["bits"].to_list()), rest["size"].to_numpy()
    letter, few = rest["letter"].to_numpy(), rest["few"].to_numpy(bool)
    true = rest["lang"].map(column).to_numpy()
    rows = np.flatnonzero(~few) if not few.all() else np.arange(len(few))

    def loss(temperature: float) -> float:
        scaled = -(bits[rows] - bits[rows].min(axis=1, keepdims=True)) / temperature
        return float((np.log2(np.exp2(scaled).sum(axis=1))
                      - scaled[np.arange(len(rows)), true[rows]]).mean())

    model.temperature = min([1.0, 1.5, 2, 3, 5, 8, 12, 20, 40], key=loss)
    entropy = bits[np.arange(len(true)), true] / size
    heads = rest["head"].to_numpy()
    for i in range(shape):
        if (mine := entropy[true == i]).size:
            model.mean[i] = np.average(mine, weights=size[true == i])
            far = (mine - model.mean[i]) * np.minimum(1, np.sqrt(letter[true == i] / FULL))
            random = random_level(model, i, heads[true == i].tolist())
            model.limit[i] = max(SLACK * np.quantile(far, QUANTILE),
                                 WAY * (random - model.mean[i]))
    return model


def random_level(model: Model, lang: int, heads: list[str]) -> float:
    """Cross-entropy of a language's own characters in random order: letters of its texts, as often
    as they are in them, whatever other languages were learnt."""
    rng = np.random.default_rng(0)
    codes, _ = normalized(heads)
    codes = rng.permutation(codes[codes != START])
    bits, size, _ = model.bits(["".join(map(chr, codes))])
    return float(bits[0, lang] / max(1, size[0]))


def bucket(key: Column, salt: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)).cast("bigint")


def train(docs: DataFrame, labelled: Column, key: str = "doc_id", text: str = "text",
          lang: str = "lang", rows: int = ROWS_PER_LANGUAGE) -> Model:
    """A model from documents with a language for which `labelled` holds.

    A language is learnt from about `rows` documents: with more, those with the lowest hashes of
    their key. Four in five of them are counted, the others calibrate; of a language with no more than
    FEW, all do both, so that none is left out. Counting and measuring run on the executors. What
    comes to the driver is bounded by this sample in number, and by SHUFFLED characters a language.
    """
    known = in_small_batches(docs).where(labelled & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        bucket(F.coalesce(F.col(key).cast("string"), F.lit("")), "rows").alias("drawn"),
        bucket(F.coalesce(F.col(key).cast("string"), F.lit("")), "part").alias("part"))
    numbers = {r["lang"]: r["n"] for r in
               known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not numbers:
        return calibrate(fit(pd.DataFrame(columns=["lang"])), pd.DataFrame())
    table = F.create_map(*[x for lang, n in numbers.items() for x in (F.lit(lang), F.struct(
        F.lit(int(min(1.0, rows / n) * (1 << 30))).alias("edge"), F.lit(n <= FEW).alias("few"),
        F.lit(max(1, SHUFFLED // max(1, min(n, rows) // (1 if n <= FEW else 5)))).alias("each")))])
    sample = known.withColumn("of", F.element_at(table, F.col("lang"))).where(
        "drawn < of.edge").select("lang", "text", "part", "of.few", "of.each")
    model = fit(count_grams(sample.where("few OR part % 5 != 0").select("lang", "text")).toPandas())
    return calibrate(model, measured(model, sample.where("few OR part % 5 = 0")))


def judged(model: Model, spark) -> object:
    """A function of a text column to (lang_pred, score, cross_entropy, rejected)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield shared.value.judge(texts.fillna("").tolist())

    return judge


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Language of each text: (key, held_out, lang_pred, score, cross_entropy, rejected).

    Learnt from documents that are not held out and have a language. The language with the lowest
    cross-entropy per character is predicted, ties to the first by name; the score is its calibrated
    probability. `und`, score 0 and rejection go to null texts and texts without a letter, and to
    all if there is nothing to learn from. A language is learnt from a single document too. A text is also rejected if its cross-entropy is above
    what texts of its predicted language reach. One row per row, repeated ones and null keys (held
    out like an empty key) too; no rows for an empty table. Very long texts are scored in
    stretches, whole. Only key, text and language are read, and the language only to learn.
    """
    model = train(docs, ~held_out(key), key, text, lang, rows)
    judge = judged(model, docs.sparkSession)
    return docs.select(F.col(key), held_out(key).alias("held_out"),
                       judge(F.col(text)).alias("_found")).select(key, "held_out", "_found.*")


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text",
               lang: str = "lang") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = train(docs, ~held_out(key), key, text, lang)
    judge = judged(model, docs.sparkSession)
    columns = docs.columns
    mark = "_rejected"
    while mark in columns:
        mark += "_"
    names = ["`" + c.replace("`", "``") + "`" for c in columns]
    return docs.withColumn(mark, judge(F.col(text))["rejected"]).where(~F.col(mark)).select(*names)
