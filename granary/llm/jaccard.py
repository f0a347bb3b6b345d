"""Exact n-gram Jaccard join by a matrix of tokens and groups.

A document's tokens are its distinct shingles, ordered by hash.  Documents that link agree on at least some number of
tokens of their first few (``kept_tokens``, ``fewest_common``); of these, tokens of one document alone fall away and
each document goes on with its rarest ones.  Documents with an equal rare token meet its pivot, and what links forms
groups.  What the pivot has is common to the documents around it and tells nothing about them, so from there on their
tokens are those by which they differ from it (``strangers``, ``differences``).  Each group stores the union of its
members' rare differences; a document of another group is compared with its members only where its overlap with that
union reaches the fewest that a link has in common.  What is opened is verified on the whole shingle sets.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import ROW, WordHashes, discard, materialised, mix64, numbered, picked, shingles

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CHUNK = 200  # texts handed on at a time
REMEMBERED = 500_000  # names of sets a task remembers
ROUNDS = 3  # times that sets which cannot link are closed
TOGETHER = 8  # common differences that a set and a group must have, where links have as many
SPARE = 12  # one token in so many is kept beyond those that a link needs for one common token


def shingle_set(text: str | None, hashes: WordHashes, width: int = 4) -> np.ndarray:
    return shingles(hashes(_WORDS.findall((text or "").translate(_LOWER))), width)


def set_name(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set: its name as a node, and a check of it."""
    with np.errstate(over="ignore"):
        a, b = mix64(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s + np.uint64(9)))
    return int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))


def kept_tokens(n: int, num: int, den: int) -> int:
    """How many of its first tokens a set of n keeps.

    A link has at least ceil(num n / den) tokens in common, n being the size of either set.  Sets that keep c tokens
    more than the rest therefore have c kept tokens in common, c being the smaller one's ``1 + n // SPARE``.
    """
    return min(n, n - -(-num * n // den) + 1 + n // SPARE)


def fewest_common(n: str, num: int, den: int) -> str:
    """SQL for the fewest kept tokens that a set of ``n`` has in common with any set it links with."""
    return f"(1 + (({n} * {num} + {den - 1}) div {den}) div {SPARE})"


def components(spark, edges: DataFrame) -> DataFrame:
    """(node, component) of undirected edges (a, b): the smallest node reachable.

    Rounds of smallest neighbour and pointer jumping, each written to the shared folder; hot nodes are reduced
    before the shuffle.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialised(both.where("a <> b").distinct(), "jaccard-edges")
    label = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))
    label = materialised(label, "jaccard-labels")
    while True:
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("component").alias("m"))
        step = label.join(near, label.node == near.a).select("node", F.least("component", "m").alias("new"), "component")
        up = label.select(F.col("node").alias("up"), F.col("component").alias("top"))
        step = step.join(up, step.new == up.up, "left").select(
            "node", F.least("new", F.coalesce("top", "new")).alias("component"), F.col("component").alias("old")
        )
        step = materialised(step, "jaccard-labels")
        changed = step.where("component <> old").limit(1).count()
        label = step.select("node", "component")
        if not changed:
            return label


def score(n: str, apart: str, num: int, den: int) -> str:
    """SQL for how far a set of ``n`` is from a third one: two sets link for sure where their scores sum to 0 or less.

    Sets of a and b tokens link where (den + num) times the tokens that only one of them has are at most
    (den - num) (a + b); that number is no more than what sets each of them ``apart`` from the third set together.
    """
    return f"cast({den + num} * ({apart}) - {den - num} * {n} as bigint)"


def counted(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """The pairs (a, b) with their sizes na, nb, the numbers ka, kb of their shared tokens, and how many both have."""
    left = tokens.select(F.col("short").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("short").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))

    def count(batches):
        for b in batches:
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(b.ta, b.tb)]
            yield b[["a", "b", "na", "nb"]].assign(ka=[len(x) for x in b.ta], kb=[len(x) for x in b.tb], common=common)

    rows = pairs.select("a", "b").join(left, "a").join(right, "b")
    return rows.mapInPandas(count, "a long, b long, na int, nb int, ka int, kb int, common int")


def strangers(stars: DataFrame, label: DataFrame, num: int, den: int) -> DataFrame:
    """The stars' sets that may link with a set of another component in the same star, and how much to keep of them.

    What sets a set off from its pivot's shared tokens are its extra and its missing tokens.  Two sets that link, and
    whose scores do not say so already, have half the sum of their scores of these in common, and of the extra ones at
    least as many as a link needs beyond what the pivot has.  A set that shares fewer with anyone is closed; that
    raises the least score of the others.  ``kept`` of the first differences then hold ``fewest`` common ones, and all
    but ``left``, the number of those not kept.
    """
    named = label.select(F.col("node").alias("b"), "component")
    homes = label.select(F.col("node").alias("a"), F.col("component").alias("home"))
    rows = stars.join(named, "b", "left").join(homes, "a", "left").select(
        F.col("a").alias("pivot"), F.col("b").alias("short"), F.col("nb").alias("n"), "score", F.coalesce("component", "b").alias("component"),
        F.expr("coalesce(coalesce(component, b) = coalesce(home, a), false)").alias("at_home"),
        F.expr("kb - common").alias("extra"), F.expr("ka - common").alias("missing"),
        F.expr(f"(nb * {num} + {den - 1}) div {den} - common").alias("beyond"),
    )
    for _ in range(ROUNDS):
        ends = rows.groupBy("pivot").agg(
            F.min("score").alias("lowest"), F.min(F.when(~F.col("at_home"), F.col("score"))).alias("outside"),
            F.min("component").alias("lo"), F.max("component").alias("hi"),
        ).where("lo <> hi").drop("lo", "hi")
        half = F.expr(f"greatest(1, cast(ceil((score + if(at_home, outside, lowest)) / {2 * (den + num)}d) as bigint))")
        rows = rows.drop("alike").join(ends, "pivot").withColumn("alike", half).where("extra + missing >= alike").drop("lowest", "outside")
        rows = materialised(rows, "jaccard-strangers")
    most = rows.groupBy("pivot").agg(F.least(F.lit(TOGETHER), F.min(F.greatest("alike", "beyond"))).alias("fewest"))
    rows = rows.join(most, "pivot")
    kept = F.least(
        F.when(F.col("alike") >= F.col("fewest"), F.expr("extra + missing - alike + fewest")),
        F.when(F.col("beyond") >= F.col("fewest"), F.expr("extra - beyond + fewest")),
    )
    return rows.withColumn("kept", kept).withColumn("left", F.expr("extra + missing - kept"))


def differences(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """The first ``kept`` tokens that set each set off from its pivot: extra ones first, the rarest before the others,
    then missing ones, those before that fewer sets lack."""
    mine = tokens.select("short", F.col("tokens").alias("t"))
    theirs = tokens.select(F.col("short").alias("pivot"), F.col("tokens").alias("tp"))

    def first(batches):
        for b in batches:
            keys = []
            for t, tp, kept in zip(b.t, b.tp, b.kept):
                keys.append(np.concatenate([t[~np.isin(t, tp)], tp[~np.isin(tp, t)][::-1]])[:kept])
            yield b[["pivot", "short", "n", "component", "fewest", "score", "left", "kept"]].assign(keys=keys)

    joined = rows.select("pivot", "short", "n", "component", "fewest", "score", "left", "kept").join(mine, "short").join(theirs, "pivot")
    schema = "pivot long, short long, n int, component long, fewest long, score long, left long, kept long, keys array<long>"
    return joined.mapInPandas(first, schema)


def join(docs: DataFrame, num: int = 85, den: int = 100, width: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; documents link when den * common >= num * united.

    Null and empty texts have no shingles and link with nothing.  Repeated ids stay; equal texts link.  A component
    is named by the smallest id in it, by null if all are null.
    """
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "jaccard-rows")
    return linked(rows, num, den, width, spent=rows).select(
        "doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id")
    )


def linked(rows: DataFrame, num: int, den: int, width: int, spent: DataFrame | None = None) -> DataFrame:
    """Row id, doc_id, n_shingles and first row (none, doc_id, row) of the component of every numbered row.

    Rows with equal sets form a class first, and only one of each class is compared.  The first row is the one with
    the smallest id, null ids last; it is null for rows that have no shingles.  ``spent`` is a scratch table that is
    removed when the texts have been read for the last time.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")

    def sets(batches):
        hashes, seen = WordHashes(), set()
        for b in batches:
            for lo in range(0, len(b), CHUNK):
                rows = b.iloc[lo : lo + CHUNK]
                sizes, names, checks, keys = [], [], [], []
                for t in rows.text:
                    s = shingle_set(t, hashes, width)
                    name, check = set_name(s)
                    sizes.append(len(s))
                    names.append(name)
                    checks.append(check)
                    # a task gives the tokens of equal sets once; forgetting some only repeats them
                    fresh = len(s) and name not in seen
                    keys.append(s[: kept_tokens(len(s), num, den)].view(np.int64) if fresh else None)
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(name)
                yield pd.DataFrame({
                    "row": rows.row.array, "doc_id": rows.doc_id.array, "n_shingles": sizes, "short": names, "check": checks, "keys": keys,
                }).astype({"doc_id": "Int64"})

    schema = "row long, doc_id long, n_shingles long, short long, check long, keys array<long>"
    found = materialised(plain.mapInPandas(sets, schema), "jaccard-sets")
    reps = found.where("n_shingles > 0").groupBy("short", "check").agg(
        F.min("row").alias("rep"), F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")).alias("first")
    )
    reps = materialised(reps, "jaccard-classes")
    keys = found.where("keys is not null").select("short", F.col("n_shingles").cast("int").alias("n"), F.explode("keys").alias("key"))
    # most tokens are in one set only: the others go on
    again = keys.groupBy("key").agg(F.count("*").alias("sets"), F.min("short").alias("lo"), F.max("short").alias("hi"))
    again = materialised(again.where("lo <> hi").select("key", "sets"), "jaccard-again")
    # sets with fewer tokens in common with all others together than any link has are left closed
    able = keys.join(again, "key").groupBy("short").agg(F.max("n").alias("n"), F.countDistinct("key").alias("c"))
    able = able.where("c >= " + fewest_common("n", num, den)).select("short")
    # the shingles of what is opened, worked out again from the representative's text
    opened = materialised(reps.join(able, "short").select(F.col("rep").alias(ROW)), "jaccard-opened")
    wide, found = found, materialised(found.drop("keys"), "jaccard-named")
    discard(wide)

    def bodied(batches):
        hashes = WordHashes()
        for b in batches:
            for lo in range(0, len(b), CHUNK):
                rows = b.iloc[lo : lo + CHUNK]
                sets = [shingle_set(t, hashes, width) for t in rows.text]
                yield pd.DataFrame({
                    "short": [set_name(s)[0] for s in sets], "n": [len(s) for s in sets], "tokens": [s.view(np.int64) for s in sets],
                })

    texts = picked(rows, opened).select("text")
    bodies = texts.mapInPandas(bodied, "short long, n int, tokens array<long>")
    bodies = materialised(bodies, "jaccard-bodies")
    if spent is not None:
        discard(spent)
    # the same over all tokens of the opened sets, the rarest first: a link has ``least`` in common, so all but that
    # many of the tokens that a set shares with others, and one more, hold a token that both have
    least = f"((n * {num} + {den - 1}) div {den})"
    every = bodies.select("short", "n", F.explode("tokens").alias("key"))
    again = every.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
    tokens = every.join(again, "key").groupBy("short").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("sets", "key"))).alias("tokens")
    )
    tokens = materialised(tokens.where(f"size(tokens) >= {least}").withColumn("tokens", F.col("tokens.key")), "jaccard-tokens")
    discard(bodies)
    # the pivot of a token is the set with the fewest tokens of its own: copies of one text link with the least altered
    rare = tokens.select(
        "short", "n", F.expr("n - size(tokens)").alias("own"), F.explode(F.expr(f"slice(tokens, 1, size(tokens) - {least} + 1)")).alias("key")
    )
    groups = rare.groupBy("key").agg(
        F.min(F.struct("own", "short")).alias("pivot"), F.min("short").alias("lo"), F.max("short").alias("hi"),
        F.max("n").alias("largest"), F.min("n").alias("smallest"),
    ).where("lo <> hi").select("key", F.col("pivot.short").alias("pivot"), "largest", "smallest")
    stars = rare.join(groups, "key").where(
        # sets all too small or too large for this one cannot link with it
        (F.col("n") * num <= F.col("largest") * den) & (F.col("smallest") * num <= F.col("n") * den)
    ).where("short <> pivot").select(F.col("pivot").alias("a"), F.col("short").alias("b")).distinct()
    stars = materialised(counted(materialised(stars, "jaccard-stars"), tokens), "jaccard-measured")
    linking = f"{den} * common >= {num} * (na + nb - common)"
    # sets with a common rare token share its pivot: they are told apart by what sets them off from the pivot
    stars = stars.withColumn("score", F.expr(score("nb", "ka + nb - 2 * common", num, den)))
    nearest = stars.groupBy("a").agg(F.min(F.struct("score", "b")).alias("near"))
    sure = stars.join(nearest, "a").where("score + near.score <= 0 and b <> near.b").select(F.col("near.b").alias("a"), "b")
    links = materialised(stars.where(linking).select("a", "b").unionByName(sure), "jaccard-links")
    # groups are the components so far; a rare token in several groups may hide links between them
    label = components(spark, links)
    open_ = strangers(stars, label, num, den)
    kept = materialised(differences(open_, tokens).withColumn("key", F.explode("keys")).drop("keys"), "jaccard-kept")
    mixed = kept.groupBy("pivot", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    open_ = materialised(kept.join(mixed.select("pivot", "key"), ["pivot", "key"]), "jaccard-open")
    # the matrix: one row for each rare difference of a group's union, with the sizes of the sets that have it
    union = open_.groupBy("pivot", "key", F.col("component").alias("group")).agg(
        F.min("n").alias("smallest"), F.max("n").alias("largest"), F.min("score").alias("lowest"), F.max("left").alias("most"), F.max("kept").alias("holds")
    )
    needed = f"(cast(ceil((score + lowest) / {2 * (den + num)}d) as bigint) - greatest(left, most))"
    reach = open_.join(union, ["pivot", "key"]).where(
        (F.col("component") != F.col("group")) & (F.col("n") * num <= F.col("largest") * den) & (F.col("smallest") * num <= F.col("n") * den)
    ).where(f"{needed} <= least(kept, holds)").groupBy("pivot", "short", "component", "group").agg(
        F.count("*").alias("overlap"), F.max("n").alias("n"), F.max("fewest").alias("fewest"), F.min(F.expr(needed)).alias("needed")
    )
    # a group whose union has fewer differences in common with a set than a link has holds none
    opens = reach.where("overlap >= greatest(fewest, needed)")
    opens = materialised(opens.select("pivot", "short", "component", "group", "n"), "jaccard-opens")
    # both sets of a link open each other's group
    left, right = (
        opens.select("pivot", F.col("short").alias(x), F.col("n").alias("n" + x), F.col("component").alias("c" + x), F.col("group").alias("c" + y))
        for x, y in ("ab", "ba")
    )
    fits = f"least(na, nb) * {den} >= greatest(na, nb) * {num}"
    rest = left.join(right, ["pivot", "ca", "cb"]).where("a < b").where(fits).select("a", "b").distinct()
    rest = counted(materialised(rest, "jaccard-rest"), tokens).where(linking).select("a", "b")
    rest = materialised(rest, "jaccard-links")
    discard(tokens)
    label = components(spark, links.unionByName(rest))
    # the first row of every component, through the classes
    classes = reps.join(label, F.col("short") == label.node, "left")
    classes = classes.select("short", "check", "first", F.coalesce("component", "short").alias("component"))
    lowest = classes.groupBy("component").agg(F.min("first").alias("first"))
    named = classes.drop("first").join(lowest, "component").select("short", "check", "first")
    return found.join(named, ["short", "check"], "left").select("row", "doc_id", "n_shingles", "first")


def keep_one(docs: DataFrame, num: int = 80, den: int = 100, width: int = 5) -> DataFrame:
    """The row with the smallest id of each component; null ids come last, and of a repeated id one row is the first.

    Rows are kept or dropped by their texts alone, so rows that link with nothing stay whatever their ids.  Near
    duplicates have a Jaccard of at least 0.8 over five-word shingles; the defaults of ``join`` are its query's own.
    """
    rows = numbered(docs, "jaccard-rows")
    kept = linked(rows, num, den, width).where("first IS NULL OR first.row = row").select(F.col("row").alias(ROW))
    return picked(rows, materialised(kept, "jaccard-kept")).select(*docs.columns)
