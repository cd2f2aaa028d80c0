"""Spelling variants by a permuterm index: words one edit apart are neighbours in its sorted rotations.

A word is closed by a mark and listed in all its rotations. An edited character stands last in one of
them, so what precedes it is a prefix that both words share:

- `w` with its character j replaced: both words' rotations behind j agree in all but the last place;
- `w` with a character inserted at j: the longer word's rotation behind j is a whole rotation of `w`
  with one character more.

Each rotation is therefore sorted under two prefixes, itself and itself without its last character. A
prefix range holds at most one whole rotation and one rotation for each character there is, whatever
the corpus, and one scan in sorted order gives every member its number of neighbours and the best of
them. No pair is listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtables.llm.shared import in_small_batches, kept, ranked

#: Maximal runs of these are words: Latin letters, accented ones too.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
#: The mark that closes a word; no letter.
MARK = "$"
LEAST_LENGTH, LEAST_COUNT, MORE = 7, 2, 10
#: A run loses a character if this divides its checksum.
EVERY = 31
#: Prefixes above this length are sorted by a fingerprint of 124 bits, so a word of a million letters
#: takes a million short rows and not a million long ones.
LONG = 64
#: Primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (911382323, 972663749, 1000003, 754974721)
#: Rotations that leave Python at once.
ROWS = 1 << 16
FIRST, OTHER, WHOLE = 0, 1, 2


def lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text",
                least: int = LEAST_LENGTH) -> DataFrame:
    """(word): a row per run that is long enough after the deletion its checksum asks for."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
                       F.explode(runs).alias("run")).select("id", lower(F.col("run")).alias("run"))
    each = each.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % EVERY == 0, F.concat(
        F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run"))
    )).otherwise(F.col("run"))
    return each.select(word.alias("word")).where(F.length("word") >= least)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text",
               least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n, pref): `pref` numbers words from the most frequent one on, ties in code-point
    order. It stands for the word wherever words are compared."""
    words = occurrences(docs, key, text, least).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= count)
    return kept(ranked(words.select("word", "n", (-F.col("n")).alias("rare"), F.lit(0).alias("all")),
                       "all", ["rare", "word"], "pref").select("word", "n", "pref"))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, kind, pref): every rotation under its two prefixes.

    WHOLE: the rotation itself. FIRST, OTHER: the rotation without its last character, which is one of
    the word; FIRST if it does not repeat the character before it in the word, since leaving out any of
    a run of equal characters gives the same word.
    """
    short = words.where(F.length("word") <= LONG).withColumn("m", F.concat("word", F.lit(MARK)))
    at = F.sequence(F.lit(0), F.length("word"))
    size = F.length("m")
    whole = short.where(F.length("word") < LONG).select(
        "pref", "m", F.explode(at).alias("i")).select(
        F.concat(F.substring("m", F.col("i") + 1, size), F.substring("m", F.lit(1), F.col("i")))
        .alias("prefix"), F.lit(WHOLE).alias("kind"), "pref")
    again = (F.col("i") > 0) & (F.substring("m", F.col("i"), F.lit(1))
                                == F.substring("m", F.col("i") + 1, F.lit(1)))
    edited = short.select("pref", "m", F.explode(F.sequence(F.lit(0), F.length("word") - 1))
                          .alias("i")).select(
        F.concat(F.substring("m", F.col("i") + 2, size), F.substring("m", F.lit(1), F.col("i")))
        .alias("prefix"), F.when(again, OTHER).otherwise(FIRST).alias("kind"), "pref")
    long = in_small_batches(words.where(F.length("word") >= LONG).select("word", "pref"))
    return whole.unionByName(edited).unionByName(
        long.mapInPandas(long_rotations, "prefix string, kind int, pref bigint"))


def fingerprints(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a closed word: of its rotations from each place on, and of these without the last character.

    Four polynomials modulo primes. With prefix sums, a rotation is the sum behind the place and the
    sum ahead of it, each moved to where it stands.
    """
    size = len(points)
    whole, edited = (np.zeros((size, len(PRIMES)), np.uint32) for _ in range(2))
    for c, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
        up, down = powers(base, size + 1, prime), powers(pow(base, -1, prime), size + 1, prime)
        sums = np.zeros(size + 1, np.int64)
        np.cumsum(points * up[:size] % prime, out=sums[1:])
        sums %= prime
        behind = (sums[size] - sums[:size]) % prime * down[:size] % prime
        ahead = sums[:size] * up[size - np.arange(size)] % prime
        turned = (behind + ahead) % prime
        whole[:, c] = turned
        # The rotation from i + 1 on ends in character i.
        edited[:, c] = (np.roll(turned, -1) - points * up[size - 1]) % prime
    return whole, edited


def powers(base: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[:n]


def long_rotations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What `rotations` lists, for words whose prefixes are too long to be sorted as they are."""

    def shown(found: np.ndarray, begin: int, size: int) -> list[str]:
        raw = np.ascontiguousarray(found[begin:begin + ROWS]).tobytes().hex()
        return [f"{size}:{raw[i:i + 32]}" for i in range(0, len(raw), 32)]

    for batch in batches:
        for word, pref in zip(batch["word"], batch["pref"], strict=True):
            points = np.frombuffer((word + MARK).encode("utf-32-le"), "<u4").astype(np.int64)
            size = len(points)
            whole, edited = fingerprints(points)
            for begin in range(0, size, ROWS):
                yield pd.DataFrame({"prefix": shown(whole, begin, size), "kind": WHOLE,
                                    "pref": pref})
            if len(word) > LONG:
                again = np.concatenate([[False], points[1:] == points[:-1]])
                for begin in range(0, size - 1, ROWS):
                    end = min(begin + ROWS, size - 1)
                    yield pd.DataFrame({"prefix": shown(edited[:size - 1], begin, size - 1),
                                        "kind": np.where(again[begin:end], OTHER, FIRST),
                                        "pref": pref})


def neighbours(words: DataFrame) -> DataFrame:
    """(pref, n_near, best): how many words are one edit away, and the first of them by `pref`.

    One scan of the sorted prefixes. In a range, rotations with a character more are replacements
    of each other; the FIRST ones are the whole rotation's word with a character inserted.
    """
    kind, pref = F.col("kind"), F.col("pref")
    order = Window.partitionBy("prefix").orderBy(kind == WHOLE, "pref")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scanned = rotations(words).select(
        "kind", "pref", F.row_number().over(order).alias("place"),
        F.lead(F.when(kind != WHOLE, pref)).over(order).alias("next"),
        F.count(F.when(kind != WHOLE, 1)).over(every).alias("edited"),
        F.count(F.when(kind == FIRST, 1)).over(every).alias("firsts"),
        F.min(F.when(kind != WHOLE, pref)).over(every).alias("least"),
        F.min(F.when(kind == FIRST, pref)).over(every).alias("inserted"),
        F.min(F.when(kind == WHOLE, pref)).over(every).alias("whole"))
    replaced = F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("least"))
    shorter = F.when(kind == FIRST, F.col("whole"))
    near = F.when(kind == WHOLE, F.col("firsts")).otherwise(
        F.col("edited") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
    best = F.when(kind == WHOLE, F.col("inserted")).otherwise(F.least(replaced, shorter))
    return scanned.select("pref", near.alias("near"), best.alias("best")).where("near > 0").groupBy(
        "pref").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(pref, root): where following links (pref, form) ends. Chains shrink by half each round, and
    are short: a form is MORE times as frequent as its word."""
    found = kept(links.select("pref", F.col("form").alias("root")))
    while True:
        next_ = found.select(F.col("pref").alias("at"), F.col("root").alias("further"))
        stepped = kept(found.join(next_, F.col("root") == F.col("at"), "left").select(
            "pref", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")))
        found = stepped.select("pref", "root")
        if stepped.where("moved").isEmpty():
            return found


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH,
             count: int = LEAST_COUNT, more: int = MORE) -> DataFrame:
    """The words of all texts with the spelling they vary: (word, form, root, n, n_near, form_n).

    Words are maximal runs of LETTERS, A-Z lower-cased, one code point left out where the checksum of
    key and run says so; those of at least `least` code points that occur `count` times. Two words are
    near if one code point is inserted, deleted or replaced. The form of a word is its most frequent
    near word, of equally frequent ones the first in code-point order, if it is `more` times as
    frequent; the root is the last form of forms. Null and empty texts have no words; a null key is an
    empty one; repeated rows count each. Words may have any length. A table without words gives no
    rows. Other columns are not read.
    """
    words = vocabulary(docs, key, text, least, count)
    near = neighbours(words)
    best = words.select(F.col("pref").alias("best"), F.col("word").alias("form"),
                        F.col("n").alias("form_n"))
    known = kept(words.join(near, "pref", "left").join(best, "best", "left").select(
        "word", "n", "pref", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        *[F.when(F.col("form_n") >= more * F.col("n"), F.col(c)).alias(c)
          for c in ("best", "form", "form_n")]))
    ends = roots(known.where("best IS NOT NULL").select("pref", F.col("best").alias("form")))
    last = ends.join(words.select(F.col("pref").alias("root"), F.col("word").alias("end")), "root")
    return known.join(last.select("pref", "end"), "pref", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
