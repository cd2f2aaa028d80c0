"""Jaccard join of documents by their word n-grams under several global token orders.

If two sets agree to a share t, then under any total order of all tokens they share one of the first
n - ceil(t * n) + 1 tokens of each. One order proposes pairs, the others are asked before any set is
read: a pair goes on only if its prefixes meet in every order, and if its marks differ in no more places
than the sets may. Marks are a bit for each of some places, the parity of the tokens that fall there, so
two sets' marks never differ more than the sets do.

The proposing order puts rare tokens first. How many sets hold a token is counted over all of them, for
a fixed part of the tokens, chosen by hash (SAMPLED): these come first, from the rarest on; all others
come behind in the order of their hashes. Tokens of one set alone propose nothing, so most texts
propose nothing at all; they take up the prefix and are dropped at once. The other orders are by salted
hashes. Sets that are equal are one set with several documents throughout.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtables.llm.components import connected
from logtables.llm.orderhash import Powers, candidates, mixed, portions
from logtables.llm.shared import folder, in_small_batches, kept, release
from logtables.session import delete_dir

#: Words to a token, and the least share in percent of two sets' union that they have in common.
WORDS, PERCENT = 3, 90
#: One in so many tokens is counted and comes first in the proposing order.
SAMPLED = 4
#: Orders that are asked beside the proposing one.
SALTS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)
#: Buckets of up to SMALL sets list their pairs; larger ones are compared by blocks of about BLOCK.
SMALL, BLOCK = 32, 2048
#: Sets of a block that are compared with all others at once.
ROWS = 256
#: A set has a power of two of marks, at least PLACES for each token, within these bounds.
PLACES, FEWEST, MOST = 4, 512, 1 << 16
#: Bytes of marks that are compared at once.
COMPARED = 1 << 23
#: Bits, 4 MB in all, by which rows are passed over that are not in a list.
BITS = 1 << 25
#: The id that stands for a null one.
LEAST = -(1 << 63)
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
CAPITAL = np.arange(256, dtype=np.uint8)
CAPITAL[65:91] += 32
GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes whose words are hashed at once.
STRETCH = 1 << 20
POWERS = Powers()
FOUND = ("id bigint, tag bigint, same binary, size int, sampled array<bigint>, rest array<bigint>, "
         "orders array<array<int>>")


def prefix_size(size: int, percent: int = PERCENT) -> int:
    return size - -(-percent * size // 100) + 1


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text that ends in a blank, and where each begins.

    Words are runs of other bytes than blanks, A-Z lower-cased. A long text is taken in stretches that
    end at a blank, so tables are as long as a stretch or the longest word.
    """
    hashes, places, begin = [], [], 0
    while begin < len(data):
        found = GAP.search(data, min(begin + STRETCH, len(data) - 1))
        part = CAPITAL[np.frombuffer(data, np.uint8, found.end() - begin, begin)]
        edge = np.diff((~BLANK[part]).view(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = POWERS.get(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
            hashes.append(mixed((sums[ends] - sums[starts]) * down[starts]
                                + (ends - starts).astype(np.uint64)))
        places.append(starts + begin)
        begin = found.end()
    return np.concatenate(hashes), np.concatenate(places)


def token_sets(texts: list[str], width: int = WORDS) -> list[np.ndarray]:
    """The distinct tokens of each text, hashed and sorted: `width` consecutive words, or all of a
    text's words if it has fewer."""
    if not texts:
        return []
    raw = [t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    words, starts = word_hashes(b"".join(raw))
    places = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
            some = min(width, b - a)
            token = np.full(b - a - some + 1 if some else 0, some, np.uint64)
            for k in range(some):
                token = token * STEP + words[a + k:b - some + 1 + k]
            out.append(np.unique(mixed(token)))
    return out


def in_sample(tokens: np.ndarray) -> np.ndarray:
    return mixed(tokens ^ BASE) % np.uint64(SAMPLED) == 0


def listed(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """What the join needs to know of a set: its sampled tokens; those first in the order of hashes
    that may follow in the prefix if there are too few of them; its prefixes in the other orders, cut
    to 32 bits, which may only let a pair pass."""
    need = prefix_size(len(tokens), percent) if len(tokens) else 0
    mine = in_sample(tokens)
    sampled, rest = tokens[mine], tokens[~mine]
    # Tokens are sorted by hash.
    rest = rest[:max(0, need - len(sampled))]
    orders = []
    for salt in SALTS:
        value = mixed(tokens ^ np.uint64(salt))
        if need < len(value):
            value = np.partition(value, need)[:need]
        orders.append((value >> np.uint64(32)).astype(np.uint32).view(np.int32))
    return sampled, rest, orders


def described(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """FOUND of (id, tag, text); `same` is a digest of the whole set."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, tags = batch["id"].to_numpy(), batch["tag"].to_numpy()
            for begin, part in portions(batch["text"].tolist()):
                sets = token_sets(part, width)
                lists = [listed(s, percent) for s in sets]
                end = begin + len(part)
                yield pd.DataFrame({
                    "id": ids[begin:end], "tag": tags[begin:end],
                    "same": [digest(s) for s in sets],
                    "size": np.array([len(s) for s in sets], np.int32),
                    "sampled": [x[0].view(np.int64) for x in lists],
                    "rest": [x[1].view(np.int64) for x in lists],
                    "orders": [x[2] for x in lists]})

    return rows.select("id", "tag", "text").mapInPandas(describe, FOUND)


def named(rows: DataFrame, width: int) -> DataFrame:
    """(id, same, size): which set each row has."""

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["id"].to_numpy()
            for begin, part in portions(batch["text"].tolist()):
                sets = token_sets(part, width)
                yield pd.DataFrame({"id": ids[begin:begin + len(part)],
                                    "same": [digest(s) for s in sets],
                                    "size": np.array([len(s) for s in sets], np.int32)})

    return rows.select("id", "text").mapInPandas(name, "id bigint, same binary, size int")


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def marked(tokens: np.ndarray) -> bytes:
    """A set's marks: for each place, whether an odd number of tokens falls there."""
    places = min(MOST, max(FEWEST, 1 << (PLACES * len(tokens) - 1).bit_length()))
    held = np.bincount((tokens & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(held.astype(np.uint8), bitorder="little").tobytes()


def may_agree(marks: list[bytes], sizes: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int
              ) -> np.ndarray:
    """Whether the marks of the sets a[i] and b[i] allow the share; `a` and `b` are places in `marks`.

    Sets that agree differ in (100 - percent) / (100 + percent) of their sizes' sum or less. Where one
    has more marks, they are folded to the number of the other's.
    """
    lengths = np.array([len(m) for m in marks], np.int64)
    short = np.minimum(lengths[a], lengths[b])
    most = (100 - percent) * (sizes[a] + sizes[b])
    out = np.zeros(len(a), bool)
    for length in np.unique(short).tolist():
        pairs = np.flatnonzero(short == length)
        used = np.unique(np.concatenate([a[pairs], b[pairs]]))
        bits = np.stack([np.bitwise_xor.reduce(np.frombuffer(marks[i], np.uint64).reshape(
            -1, length // 8), axis=0) for i in used.tolist()])
        step = max(1, COMPARED // length)
        for some in (pairs[i:i + step] for i in range(0, len(pairs), step)):
            differ = bits[np.searchsorted(used, a[some])] ^ bits[np.searchsorted(used, b[some])]
            out[some] = (100 + percent) * np.bitwise_count(differ).sum(
                axis=1, dtype=np.int64) <= most[some]
    return out


def maybe_listed(rows: DataFrame, listed_: DataFrame, by: list[str]) -> DataFrame:
    """The rows that may have their `by` in a list, and few others while it is short against BITS.

    The list goes everywhere as bits that do not grow with it, so most other rows need not move."""
    bit = F.pmod(F.xxhash64(*by), F.lit(BITS))
    bits = listed_.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(bits), (F.bitmap_bucket_number(bit) == F.col("part")) & (
        byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0), "left_semi")


def whole_sets(rows: DataFrame, width: int) -> DataFrame:
    """(id, tokens, size, marks): the sets of (set_id, text), their hashes sorted."""

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["set_id"].to_numpy()
            for begin, part in portions(batch["text"].tolist()):
                sets = token_sets(part, width)
                yield pd.DataFrame({"id": ids[begin:begin + len(part)],
                                    "tokens": [s.tobytes() for s in sets],
                                    "size": np.array([len(s) for s in sets], np.int32),
                                    "marks": [marked(s) for s in sets]})

    return rows.select("set_id", "text").mapInPandas(
        tokens, "id bigint, tokens binary, size int, marks binary").dropDuplicates(["id"])


def prefixes(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, size, sketches): each set's prefix in the proposing order, without tokens of its own.

    Of its sampled tokens a set gets back those that other sets hold too, with their numbers; all
    others are its own and come first. Only if they leave room does a set propose anything.
    """
    each = sets.select("id", F.explode("sampled").alias("token"))
    shared = each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    back = each.join(shared, "token").select("id", "token", "n")
    own = Window.partitionBy("id")
    need = F.col("size") - F.ceil(F.lit(percent) * F.col("size") / 100).cast("int") + 1
    numbered = back.withColumns({
        "place": F.row_number().over(own.orderBy("n", "token")),
        "common": F.count("*").over(own.orderBy("n", "token").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))})
    lengths = sets.select("id", "size", need.alias("need"), F.size("sampled").alias("held"))
    first = numbered.join(lengths, "id").where(
        F.col("place") + F.col("held") - F.col("common") <= F.col("need")).select(
        "id", "size", "token")
    # Behind all sampled tokens; there are none unless these are fewer than the prefix.
    further = sets.select("id", "size", F.explode("rest").alias("token"))
    return first.unionByName(further)


def passing(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that meet in all orders and whose marks allow the share; `known` are (id, orders,
    size, marks)."""
    for name in ("a", "b"):
        pairs = pairs.join(known.select(F.col("id").alias(name), *(
            F.col(c).alias(f"{c}_{name}") for c in ("orders", "size", "marks"))), name)
    for i in range(len(SALTS)):
        pairs = pairs.where(F.arrays_overlap(F.col("orders_a")[i], F.col("orders_b")[i]))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = batch["marks_a"].tolist() + batch["marks_b"].tolist()
            sizes = np.concatenate([batch["size_a"], batch["size_b"]]).astype(np.int64)
            first = np.arange(len(batch))
            yield batch.loc[may_agree(marks, sizes, first, first + len(batch), percent), ["a", "b"]]

    return pairs.select("a", "b", "size_a", "size_b", "marks_a", "marks_b").mapInPandas(
        check, "a bigint, b bigint")


def linked(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets agree."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for one, other in zip(batch["ta"], batch["tb"], strict=True):
                one, other = (np.frombuffer(t, np.uint64) for t in (one, other))
                both = len(np.intersect1d(one, other, assume_unique=True))
                good.append(100 * both >= percent * (len(one) + len(other) - both))
            yield batch.loc[good, ["a", "b"]]

    for name in ("a", "b"):
        pairs = pairs.join(tokens.select(F.col("id").alias(name), F.col("tokens").alias(f"t{name}")),
                           name)
    return pairs.select("a", "b", "ta", "tb").mapInPandas(check, "a bigint, b bigint")


def open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of rows with two sets in different components whose sizes allow the share."""
    small, large = F.least("size", "size_2"), F.greatest("size", "size_2")
    fit = rows.where((F.col("label") != F.col("label_2")) & (100 * small >= percent * large))
    return fit.select(F.least("id", "id_2").alias("a"), F.greatest("id", "id_2").alias("b")).distinct()


def paired(met: DataFrame) -> DataFrame:
    """Distinct (a, b) of sets and their hubs."""
    return met.select(F.least("id", "hub.id").alias("a"),
                      F.greatest("id", "hub.id").alias("b")).distinct()


def components(members: DataFrame, known: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """(id, label) of the sets that have a partner; `members` are (bucket, id, size, weight), `known`
    (id, orders, size, marks).

    First each set meets the heaviest of its buckets' hubs, the heaviest sets there, then all of these
    that it is not joined with yet; that joins most of a group of near copies at a cost in proportion
    to its size, with a link for each set. Then every pair of a bucket in different components is
    asked by orders and marks, in large buckets by blocks. Of the pairs that pass, the sets of each set's
    first are read, then those of the pairs that are still apart. No pair is left out but those that a
    path of links joins.
    """
    labels = kept(members.select("id").distinct().select("id", F.col("id").alias("label")))
    hubs = members.groupBy("bucket").agg(F.max(F.struct(
        "weight", (-F.col("id")).alias("first"), "id", "size")).alias("hub"))
    small, large = (f("size", "hub.size") for f in (F.least, F.greatest))
    met = kept(members.join(hubs, "bucket").where(
        (F.col("id") != F.col("hub.id")) & (100 * small >= percent * large)).select(
        "id", "hub").distinct())
    one = met.groupBy("id").agg(F.max("hub").alias("hub"))
    asked = kept(paired(one))
    labels = connected(labels, kept(linked(passing(asked, known, percent), tokens, percent)))
    release(members.sparkSession)
    mine, other = labels, labels.select(F.col("id").alias("of"), F.col("label").alias("label_2"))
    apart = met.join(mine, "id").join(other, F.col("hub.id") == F.col("of")).where(
        "label != label_2")
    more = kept(paired(apart).join(asked, ["a", "b"], "left_anti"))
    labels = connected(labels, kept(linked(passing(more, known, percent), tokens, percent)))
    release(members.sparkSession)
    asked = asked.unionAll(more)

    own = members.join(labels, "id")
    counts = own.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    open_ = kept(counts.groupBy("bucket").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"),
        F.count("*").alias("kinds")).where("kinds > 1").select(
        "bucket", F.col("top.label").alias("main"), F.col("top.n").alias("held"), "n"))
    small, large = open_.where(F.col("n") <= SMALL), open_.where(F.col("n") > SMALL)
    rest = own.join(small.select("bucket", "main"), "bucket").where("label != main").select(
        "bucket", F.col("id").alias("id_2"), F.col("size").alias("size_2"),
        F.col("label").alias("label_2"))
    listed_ = open_pairs(own.join(rest, "bucket"), percent)
    blocks = kept(by_blocks(own, large, known, percent))
    release(members.sparkSession)
    near = kept(passing(kept(listed_.unionByName(blocks).distinct().join(
        asked, ["a", "b"], "left_anti")), known, percent))
    release(members.sparkSession)
    first = first_partners(near)
    labels = connected(labels, kept(linked(first, tokens, percent)))
    release(members.sparkSession)
    one, other = (labels.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}"))
                  for c in ("a", "b"))
    left = near.join(one, "a").join(other, "b").where("label_a != label_b").select("a", "b")
    return connected(labels, kept(linked(kept(left.join(first, ["a", "b"], "left_anti")), tokens,
                                         percent)))


def first_partners(pairs: DataFrame) -> DataFrame:
    """Of (a, b), a pair for each set: the one with the smallest partner."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return kept(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def by_blocks(own: DataFrame, large: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) in large buckets that may be linked; only marks move for it."""
    return met_blocks(own, large).join(known.select("id", "size", "marks"), "id").groupBy(
        "bucket", "one", "two").applyInPandas(
        lambda key, group: compare_blocks(group, key[1], key[2], percent),
        "a bigint, b bigint").distinct()


def met_blocks(own: DataFrame, large: DataFrame) -> DataFrame:
    """(bucket, id, label, mine, one, two): the pairs of blocks that a set takes part in. Whatever is not
    in its bucket's largest component meets every block, the largest component those of the others."""
    of_others, of_main = (F.ceil(n / F.lit(BLOCK)).cast("int")
                          for n in (F.col("n") - F.col("held"), F.col("held")))
    dealt = own.join(large.select("bucket", "main", of_others.alias("others"),
                                  of_main.alias("mains")), "bucket")
    main, dice = F.col("label") == F.col("main"), F.xxhash64("id", "bucket")
    # Blocks of the others come first in numbers.
    dealt = dealt.withColumn("mine", F.when(main, F.col("others") + F.pmod(dice, "mains")).otherwise(
        F.pmod(dice, "others")).cast("int"))
    return dealt.select("bucket", "id", "label", "mine", F.explode(F.sequence(F.lit(0), F.when(
        main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1)).alias("other")).select(
        "bucket", "id", "label", "mine", F.least("mine", "other").alias("one"),
        F.greatest("mine", "other").alias("two"))


def compare_blocks(group: pd.DataFrame, one: int, two: int, percent: int) -> pd.DataFrame:
    """Pairs between two blocks of a bucket, or within one, whose marks allow the share."""
    group = group.sort_values("id", ignore_index=True)
    ids, sizes = group["id"].to_numpy(), group["size"].to_numpy().astype(np.int64)
    mine, label, marks = group["mine"].to_numpy(), group["label"].to_numpy(), group["marks"].tolist()
    found = []
    for begin in range(0, len(ids), ROWS):
        row, column = np.arange(begin, min(begin + ROWS, len(ids)))[:, None], np.arange(begin, len(ids))
        good = (row < column) & (label[row] != label[column])
        if one != two:
            good &= mine[row] != mine[column]
        good &= 100 * np.minimum(sizes[row], sizes[column]) >= percent * np.maximum(
            sizes[row], sizes[column])
        a, b = (x + begin for x in np.nonzero(good))
        near = may_agree(marks, sizes, a, b, percent)
        found.append(pd.DataFrame({"a": ids[a[near]], "b": ids[b[near]]}))
    return pd.concat(found, ignore_index=True)


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """Class of each document: (key, n_shingles, component_id).

    A document's set has the distinct `width`-word shingles of its whole text, or its words as one if
    they are fewer; without words, or with a null text, it is empty and linked with nothing. Two
    documents are linked if 100 * (common shingles) >= percent * (shingles of either); a component is all
    that links join, and is named by its smallest key. A null key counts as the smallest and is shown as
    null. One row per row: repeated rows, and texts that share a key, are documents of their own. An
    empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = in_small_batches(docs).select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(LEAST)).alias("id"),
        F.xxhash64(body).alias("tag"), body.alias("text"))
    place = folder(spark, "jaccard")
    # One row stands for all with the same set; written with its number, which stays.
    described(rows, width, percent).where("size > 0").groupBy("same").agg(
        F.min(F.struct("id", "tag")).alias("first"), F.first("size").alias("size"),
        F.first("sampled").alias("sampled"), F.first("rest").alias("rest"),
        F.first("orders").alias("orders")).withColumn(
        "id", F.monotonically_increasing_id()).write.parquet(f"{place}/sets")
    release(spark)
    sets = spark.read.parquet(f"{place}/sets")
    narrow = kept(sets.select("same", "first", "id"))
    members = kept(candidates(kept(prefixes(sets, percent)).select(
        "id", "size", F.array("token").alias("sketches"))))
    release(spark)
    chosen = kept(members.select("id").distinct())
    orders = kept(sets.join(chosen, "id", "left_semi").select("id", "orders"))
    delete_dir(spark, f"{place}/sets")
    # Written, so Spark knows its size: texts are joined where they are if it is small.
    narrow.join(chosen, "id", "left_semi").select(
        F.col("id").alias("set_id"), F.col("first.id").alias("id"),
        F.col("first.tag").alias("tag")).write.parquet(f"{place}/chosen")
    texts = spark.read.parquet(f"{place}/chosen")
    tokens = kept(whole_sets(maybe_listed(rows, texts, ["id", "tag"]).join(texts, ["id", "tag"]), width))
    known = kept(orders.join(tokens.select("id", "size", "marks"), "id"))
    release(spark)
    labels = components(members, known, tokens, percent)
    classes = narrow.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = classes.groupBy("label").agg(F.min("first.id").alias("class_id"))
    of_set = classes.join(least, "label").select("same", "class_id")
    # Read again rather than kept beside the sets: texts cost less than what would be written.
    each = kept(named(rows, width))
    linked_ = each.where("size > 0").join(of_set, "same").select("id", "size", "class_id")
    alone = each.where("size = 0").select("id", "size", F.col("id").alias("class_id"))
    return linked_.unionByName(alone).select(
        F.when(F.col("id") != LEAST, F.col("id")).alias(key),
        F.col("size").cast("bigint").alias("n_shingles"),
        F.when(F.col("class_id") != LEAST, F.col("class_id")).alias("component_id"))
