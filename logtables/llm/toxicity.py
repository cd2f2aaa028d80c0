"""Toxicity of disguised text: restore words by a noisy channel, then score what they say.

Leetspeak, spacing and repetition make a lattice of readings of a token. A Viterbi search under a
character language model of the corpus, with costs for each trick, picks one. Words of the restored
text, and their stems, are evidence learnt from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm import langid
from logtables.llm.shared import in_small_batches, kept

#: What a character may stand for. Common substitutions.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Letters of other scripts that look like Latin ones. Fixed values.
ALIKE = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
         "т": "t", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "α": "a", "ε": "e", "ι": "i",
         "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
#: Costs in bits: a substitution, a symbol taken for noise, a break between words, dropping a
#: letter that repeats the one before it (in a run of three or more; in a pair).
SUBSTITUTE, NOISE, BREAK, RUN, PAIR = 1.0, 2.0, 4.0, 1.0, 8.0
#: Labelled documents that evidence is learnt from, about: those with the lowest hashes of their id.
#: The language model is counted over all documents that are not held out.
LABELLED_ROWS = 12_000
#: Evidence: a word or stem must be in so many toxic documents of the sample, with such a share of toxic
#: ones, and with such a log-likelihood ratio against chance.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_RATIO = 5, 0.9, 20.0
#: The probability that chance makes any of the words tried in a round evidence stays below this.
CHANCE = 0.01
STEMS = (4, 5, 6)
#: The score of a text with no evidence, and the score from which a text is predicted toxic.
NOTHING, TOXIC_FROM = 0.01, 0.7
REMEMBERED = 400_000

SPACED = re.compile(r"(?<!\S)\S(?: \S){2,}(?=[.,;:?!\"')]*(?!\S))")
RUNS = re.compile(r"(.)\1\1")
LONG_RUNS = re.compile(r"([^\W\d_])\1{3,}")
#: Digits alone, one of them no letter's stand-in: a number.
NUMBER = re.compile(r"[\d.,:/-]*2[\d.,:/-]*")
DOUBLED = re.compile(r"(.)\1+")
TOKEN = re.compile(r"\S+")


def count_words(docs: DataFrame) -> DataFrame:
    """N-gram counts of all words of the texts, as `langid.count_grams` gives them, for one model.

    Words are counted by batch first, so each n-gram moves once per batch and not per occurrence.
    Letters of all scripts count: a disguise may stand in for any, or stand beside them.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words: Counter = Counter()
            for text in batch["text"]:
                words.update(text.lower().split())
            for part in langid.stretches(list(words)):
                codes, places = langid.normalized([f"{w} " for _, w in part])
                found = langid.hashes(codes)
                times = np.array([words[w] for _, w in part], np.int64)
                weight = np.repeat(times, np.diff(places))
                at = np.flatnonzero(codes != langid.START)
                _, first, which = np.unique(found[-1][at], return_index=True, return_inverse=True)
                n = np.bincount(which, weights=weight[at], minlength=len(first))
                at = at[first]
                columns = {f"g{k + 1}": found[k][at].view(np.int64) for k in range(langid.ORDER)}
                columns |= {f"c{k}": found[k - 1][at - 1].view(np.int64)
                            for k in range(1, langid.ORDER)}
                yield pd.DataFrame({"lang": "all", **columns, "n": n.astype(np.int64)})

    return docs.mapInPandas(count, langid.COUNTED).groupBy("lang", *langid.GRAMS).agg(
        F.sum("n").alias("n"))


class Channel:
    """The most probable reading of a token."""

    def __init__(self, model: langid.Model):
        self.model = model
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {"model": self.model, "known": {}}

    def bits(self, context: str, char: str) -> float:
        """Cost of a character after the last ORDER - 1 ones."""
        key = context + char
        if (found := self.known.get(key)) is None:
            codes = np.array([0 if c == "\0" else ord(c) for c in key], np.uint32)
            table = langid.letters()
            codes = np.where(codes == 0, 0, table[codes]).astype(np.uint32)
            found = self.known[key] = -float(self.model.log2(codes)[-1, 0])
        return found

    def read(self, token: str, pairs: bool = False) -> str:
        """The cheapest path through the token's lattice. `pairs`: also pairs may be one letter.

        In a token without letters, what can stand for a letter does: it is neither noise nor a break.
        Beside letters beyond ASCII, a sign may also stand for those that look like its own.
        A path is a chain of its last output and the path before, whatever its length.
        """
        start = "\0" * (langid.ORDER - 1)
        states: dict[str, tuple[float, tuple | None]] = {start: (0.0, None)}
        n = len(token)
        plain, letterless = token.isascii(), not any(c.isalpha() for c in token)
        for i, char in enumerate(token):
            options: list[tuple[str, float]] = []
            if char.isalpha():
                options.append((char, 0.0))
                if char in ALIKE:
                    options.append((ALIKE[char], SUBSTITUTE))
                if i and token[i - 1] == char:
                    long = (i > 1 and token[i - 2] == char) or (i + 1 < n and token[i + 1] == char)
                    if long or pairs:
                        options.append(("", RUN if long else PAIR))
            else:
                stands = LEET.get(char, "")
                if stands and not plain:
                    stands += "".join(a for a, c in ALIKE.items() if c in stands)
                options += [(c, SUBSTITUTE) for c in stands]
                if not (letterless and options):
                    options += [("", NOISE), (" ", BREAK)]
            following: dict[str, tuple[float, tuple | None]] = {}
            for context, (cost, text) in states.items():
                for out, price in options:
                    total, after = cost + price, context
                    if out == " " and context[-1] in " \0":
                        out = ""
                    if out:
                        total += self.bits(context, out)
                        after = context[1:] + out
                    if after not in following or total < following[after][0]:
                        following[after] = (total, (text, out) if out else text)
            if len(following) > 64:
                best = sorted(following.items(), key=lambda s: s[1][0])[:64]
                following = dict(best)
            states = following
        ends = [(cost + (self.bits(c, " ") if c[-1] not in " \0" else 0.0), text)
                for c, (cost, text) in states.items()]
        least = min(cost for cost, _ in ends)
        return min(spelt(text) for cost, text in ends if cost == least).strip()


def spelt(path: tuple | None) -> str:
    """The outputs of a path, from the first."""
    out = []
    while path is not None:
        path, last = path
        out.append(last)
    return "".join(reversed(out))


def disguised(token: str) -> bool:
    """Whether a token has letters and, besides, signs of a disguise (letters of another script among
    Latin ones, too), or no letter but two and more characters that stand for some, not all the same,
    and is not a plain number with a 2."""
    if token.isalpha():
        alike = not token.isascii() and any(c in ALIKE for c in token)
        return RUNS.search(token) is not None or alike and any(c < "\u0250" for c in token)
    if any(c.isalpha() for c in token):
        return True
    signs = [c for c in token if c in LEET]
    return len(set(signs)) > 1 and not NUMBER.fullmatch(token)


def restored(token: str, channel: Channel, pairs: bool = False) -> str:
    """A lower-case token of any length as it is to be read. Of a letter repeated more than three
    times in a row three are left first, of which the reading may drop some."""
    core = token.strip(".,;:?\"'`*%&#~<>[]{}=/\\^-_)")
    if not (pairs or disguised(core)):
        return core
    return channel.read(LONG_RUNS.sub(r"\1\1\1", core), pairs)


def spaced_out(text: str) -> list[str]:
    """Runs of three and more single characters, which may be words, whole."""
    return SPACED.findall(text)


def restore_text(text: str, channel: Channel) -> str:
    """The whole text in lower case with each disguised word as it is read."""
    low = SPACED.sub(lambda m: channel.read(m[0]), text.lower())
    return TOKEN.sub(lambda m: restored(m[0], channel), low)


def stems(reading: str) -> Iterator[str]:
    """The words of a reading, `=` in front, and their stems."""
    for word in reading.split():
        yield f"={word}"
        for n in STEMS:
            if len(word) >= n:
                yield word[:n]


class Evidence(dict):
    """Evidence in a token, remembered. `weights` may be None: then all words and stems count."""

    def __init__(self, channel: Channel, weights: dict[str, float] | None):
        super().__init__()
        self.channel, self.weights = channel, weights
        self.squeezed = {DOUBLED.sub(r"\1", w.lstrip("=")) for w in weights or ()}

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = set(stems(restored(token, self.channel)))
        if self.weights is not None:
            found &= self.weights.keys()
            if not found and DOUBLED.search(token):
                # Pairs are common, so they are read as a disguise only near known evidence.
                plain = DOUBLED.sub(r"\1", token.strip(".,;:?!\"'"))
                if any(s.lstrip("=") in self.squeezed for s in stems(plain)):
                    found = set(stems(restored(token, self.channel, True))) & self.weights.keys()
        if self.weights is not None and found:
            # Stems of one word are no independent evidence: the surest speaks for the token.
            found = {max(found, key=lambda w: (self.weights[w], len(w), w))}
        self[token] = out = tuple(found)
        return out

    def of(self, text: str) -> set[str]:
        low = text.lower()
        found: set[str] = set()
        for token in set(low.split()):
            found.update(self[token])
        for run in spaced_out(low):
            found.update(self[run])
        return found


@dataclass
class Scorer:
    """A channel and the weight of each piece of evidence: how surely it marks a toxic text."""

    channel: Channel
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, found: set[str]) -> float:
        clean = 1 - NOTHING
        for word in found:
            clean *= 1 - self.weights[word]
        return 1 - clean


def learn_channel(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Channel:
    """The character model of all documents that are not held out."""
    texts = in_small_batches(docs).where(~langid.held_out(key) & F.col(text).isNotNull()).select(
        F.col(text).alias("text"))
    model = langid.fit(count_words(texts).toPandas())
    if not model.langs:
        model = langid.fit(pd.DataFrame({"lang": ["all"], "n": [1]} | {
            g: [i + 1] for i, g in enumerate(langid.GRAMS)}))
    return Channel(model)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", rows: int = LABELLED_ROWS) -> Scorer:
    """Channel and evidence from documents that are not held out.

    Evidence is found in rounds over a bounded sample of labelled documents with different texts. A
    round looks only at toxic documents without evidence so far, and takes the words whose ratio is
    at least half of the highest one; so words that merely keep company with evidence explain
    nothing and are not taken. The least number and share of documents are of the whole sample, the
    ratio is of the documents looked at. Rounds end when no word is left that passes: each explains some
    documents, and only toxic ones are counted anew.
    """
    spark = docs.sparkSession
    channel = learn_channel(docs, key, text)
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(
        F.col(key).alias("_key")).agg(F.max(label).alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    drawn = langid.bucket(F.col(key).cast("string"), "labels") < int(share * (1 << 30))
    sample = kept(docs.where(~langid.held_out(key) & F.col(text).isNotNull() & drawn)
                  .select(F.col(key).alias("_key"), F.col(text).alias("text"))
                  .join(known, "_key").groupBy(F.xxhash64("text").alias("same"))
                  .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")))
    scorer = Scorer(channel)

    def counts(rows: DataFrame, so_far: Scorer, name: str) -> DataFrame:
        """In how many of the rows without evidence so far each word or stem is; '' is in all."""
        shared = spark.sparkContext.broadcast(so_far)

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = shared.value
            every, have = Evidence(known.channel, None), Evidence(known.channel, known.weights)
            for batch in batches:
                n: Counter = Counter()
                for body in batch["text"]:
                    if not (known.weights and have.of(body)):
                        n.update([*every.of(body), ""])
                yield pd.DataFrame([*n.items()], columns=["word", "n"])

        return kept(rows.select("text").mapInPandas(count, "word string, n bigint")
                    .groupBy("word").agg(F.sum("n").alias(name)))

    clean = counts(sample.where("toxic = 0"), scorer, "n0")
    none = clean.where("word = ''").first()
    others = max(1, none["n0"] if none else 0)
    whole = None
    while True:
        toxic = counts(sample.where("toxic = 1"), scorer, "n1")
        left = toxic.where("word = ''").first()
        if not left:
            break
        most, tried = left["n1"], max(1, toxic.count() - 1)
        if whole is None:
            whole = toxic.withColumnRenamed("n1", "n").where(F.col("n") >= LEAST_DOCUMENTS)
        found = toxic.where("word != ''").join(whole, "word").join(clean, "word", "left").select(
            "word", "n1", "n", F.coalesce("n0", F.lit(0)).alias("n0")).where(
            F.col("n") >= LEAST_SHARE * (F.col("n") + F.col("n0")))
        ratios, new = {}, {}
        # No more than the words of the sample, which is bounded.
        for row in found.collect():
            n1, n0, n = row["n1"], row["n0"], row["n"]
            share_all = (n1 + n0) / (most + others)
            ratio = 2 * (n1 * np.log(n1 / (most * share_all))
                         + (n0 * np.log(n0 / (others * share_all)) if n0 else 0))
            if ratio >= LEAST_RATIO and tried * math.erfc(math.sqrt(ratio / 2)) <= CHANCE:
                p = (n + 0.5) / (n + n0 + 1)
                ratios[row["word"]] = ratio
                new[row["word"]] = float(p - np.sqrt(p * (1 - p) / (n + n0 + 1)))
        if not new.keys() - scorer.weights.keys():
            break
        highest = max(ratios.values())
        new = {word: weight for word, weight in new.items() if 2 * ratios[word] >= highest}
        scorer = Scorer(channel, {**new, **scorer.weights})
    return scorer


RESULT = "score double, words array<string>"


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "toxic", rows: int = LABELLED_ROWS) -> DataFrame:
    """Toxicity of each whole text: (key, held_out, score, predicted, words).

    `words` are the evidence found in the restored text, `=` before whole words. Null and empty
    texts have none; so have all texts when no label can be learnt from. Null keys and repeated
    rows are scored row by row; a document labelled twice counts as toxic if either says so; labels
    other than 0 and 1 are ignored. An empty table gives no rows. Only key, text and the label are
    read, the label only for documents that are not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, key, text, label, rows))

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = shared.value
        evidence = Evidence(scorer.channel, scorer.weights)
        for texts in batches:
            found = [evidence.of(body) for body in texts.fillna("")]
            yield pd.DataFrame({"score": [scorer.score(f) for f in found],
                                "words": [sorted(f) for f in found]})

    scored = docs.select(F.col(key), langid.held_out(key).alias("held_out"),
                         score(F.col(text)).alias("_found"))
    return scored.select(key, "held_out", "_found.score",
                         (F.col("_found.score") >= TOXIC_FROM).cast("int").alias("predicted"),
                         "_found.words")


def restore(docs: DataFrame, channel: Channel, text: str = "text", into: str = "restored"
            ) -> DataFrame:
    """Add the restored whole text, in lower case. Null: empty."""
    shared = docs.sparkSession.sparkContext.broadcast(channel)

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([restore_text(t, shared.value) for t in texts.fillna("")])

    return docs.withColumn(into, read(F.col(text)))
