"""N-gram Jaccard join by a token-group matrix.

Documents are sets of 5-word shingles, and two of them link when 100 * intersection >= 75 * union.

1. Equal sets are one set. Each set gives its prefix: the shingles that are first in a global order,
   listed common ones last, so many that two linked sets share at least 1 + n / SPARE of them, n the
   smaller size. The order steers the amount of work only; the result is the same under any.
2. So a set can do without the n / SPARE of its prefix shingles that most others have, and the rarest
   that it shares with a linked set still stands. Common ones stay, but bound the overlap by what
   comes behind them in both sets.
3. At each shingle a set meets the set with the fewest uncommon shingles, which is in the midst of its
   like, and the next one before it. Those with which it shares much are compared with it. The links
   found join most similar sets. Sets that are linked, or met the same set most often, form a group;
   groups are cut into blocks of similar size.
4. The matrix holds for each block the union of its shingles. A set asks the blocks with which it
   shares a prefix shingle and that have members it isn't connected with. The overlap with the union
   bounds the overlap with every member, so only blocks that reach the bound are opened and those
   members compared.

Defined cases. Null text, or text without words: no shingles, linked with nothing, its own
component. Fewer than five words: the whole sequence is the one shingle. Repeated rows are equal
sets. A row without doc_id keeps its shingle count, links with nothing and has a null component.
Shingles are compared by 64-bit hashes. Very long texts only make a larger slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.components import components
from stratiform.llm.tables import in_arrow, ship, stored, table
from stratiform.llm.texts import LOWER, Lookup, flat, hash_spans, mix, slices, sums, windows, words

SIZE = 5
SHARE = 75
BLOCK = 64
#: Sets that ask a block in one task; a block that more ask is copied.
ASKS = 512
#: A prefix is longer by one shingle for every SPARE in the set, and linked sets share as many more.
SPARE = 25
#: Shingles listed as common; the list orders prefixes and decides nothing else.
COMMON = 250_000
GATHERED = 2_000_000


def shingles(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and their bounds by row."""
    data, bounds = flat(column)
    data = LOWER[data]
    starts, ends, first = words(data, bounds)
    hashes = hash_spans(data, starts, ends)
    grams, at = windows(hashes, first, size)
    row = np.repeat(np.arange(len(column)), np.diff(at))
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    if len(few):  # the whole sequence, told apart from full windows by its length
        whole = np.array([hashes[first[i] : first[i + 1]] @ np.arange(3, 2 * (first[i + 1] - first[i]) + 3, 2, dtype=np.uint64) for i in few])
        grams = np.concatenate([grams, mix(whole + np.diff(first)[few].astype(np.uint64))])
        row = np.concatenate([row, few])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[keep], row[keep]
    return grams, np.searchsorted(row, np.arange(len(column) + 1))


def set_keys(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set, the same for equal sets."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams), dtype=np.uint64)])
    return mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


def _needed(n: np.ndarray | int, share: int):
    """The least overlap that a set of n shingles has with any set it links with."""
    return (share * n + 99) // 100


def _survey(size: int):
    """For each document its set's size and key; and the shingles seen three times or more among
    the distinct sets of a task, which every shingle of more than two sets a task is somewhere."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("token", pa.int64()), ("seen", pa.int64())])

    def common(gathered: list[np.ndarray]) -> pa.RecordBatch:
        token, seen = np.unique(np.concatenate(gathered), return_counts=True)
        token, seen = token[seen > 2].view(np.int64), seen[seen > 2]
        none = pa.nulls(len(token), pa.int64())
        return pa.record_batch([none, none, none, token, seen], schema=kinds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        gathered: list[np.ndarray] = []
        for part in slices(batches, "text"):
            grams, at = shingles(part.column("text"), size)
            n, key = np.diff(at), set_keys(grams, at)
            none = pa.nulls(len(n), pa.int64())
            yield pa.record_batch([part.column("doc_id"), n, pa.array(key, mask=n == 0), none, none], schema=kinds)
            for i in np.flatnonzero(n):
                if key[i] not in known:
                    known.add(key[i])
                    gathered.append(grams[at[i] : at[i + 1]])
            if sum(map(len, gathered)) > GATHERED:
                yield common(gathered)
                gathered = []
        if gathered:
            yield common(gathered)

    return run


def _common_list(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles with their number of binary digits, at most COMMON of them."""
    total = found.groupBy("token").agg(F.sum("seen").alias("seen")).withColumn("digits", F.length(F.bin("seen")))
    held = sorted(((r["digits"], r["count"]) for r in total.groupBy("digits").count().collect()), reverse=True)
    least, size = 65, 0
    for digits, count in held:
        if size + count > COMMON:
            break
        least, size = digits, size + count
    listed = total.filter(F.col("digits") >= least).select("token", "digits").toArrow()
    return (
        listed.column("token").to_numpy().astype(np.int64).view(np.uint64),
        listed.column("digits").to_numpy().astype(np.int64),
    )


def _prefixes(size: int, share: int, listed):
    """(token, set, n, place) of each set's prefix, with whether the token is listed as common, and how
    many of the set's tokens aren't; each set once a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, digits = listed.value
        lookup, known = Lookup(tokens), set()
        rank = np.append(digits, 0)
        for part in slices(batches, "text"):
            grams, at = shingles(part.column("text"), size)
            n, key = np.diff(at), set_keys(grams, at)
            row = np.repeat(np.arange(len(n)), n)
            common = rank[lookup.find(grams)]
            order = np.lexsort((common, row))
            rare = sums((common == 0).view(np.int8), at)
            new = np.zeros(len(n), bool)
            for i in np.flatnonzero(n):
                if key[i] not in known:
                    known.add(key[i])
                    new[i] = True
            place = np.arange(len(grams)) - np.repeat(at[:-1], n)
            take = (place <= (n - _needed(n, share) + n // SPARE)[row]) & new[row]
            columns = [grams[order][take].view(np.int64), key[row][take], n[row][take], place[take], common[order][take] > 0, rare[row][take]]
            yield pa.record_batch(columns, names=["token", "key", "n", "place", "common", "rare"])

    return run


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, rare, n, key): those whose token has two sets or more, with the first set of
    the token and the one before."""
    held = None  # the last row, which waits for its successor
    first = last = 0  # the first set of its token, and the one before it
    behind = False  # whether another set of its token came before it
    for batch in batches:
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        token, key = rows.column("token").to_numpy(), rows.column("key").to_numpy()
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        if not fresh.all():
            rows = rows.filter(pa.array(fresh))
            token, key = token[fresh], key[fresh]
        if not len(token):
            continue
        same = np.zeros(len(token) + 1, bool)
        same[1:-1] = token[1:] == token[:-1]
        start = np.maximum.accumulate(np.where(same[:-1], 0, np.arange(len(token))))
        hub = key[start]
        if held is not None:
            hub[start == 0] = first
        before = np.where(same[:-1], np.concatenate([key[:1], key[:-1]]), hub)
        if behind:
            before[0] = last
        many = same[:-1] | same[1:]
        many[0] |= behind
        many[-1] = False
        out = rows.filter(pa.array(many))
        yield pa.record_batch([*out.columns, hub[many], before[many]], names=[*out.schema.names, "hub", "before"])
        behind = bool(same[-2] or (len(token) == 1 and behind))
        held, first, last = rows.slice(len(token) - 1, 1), hub[-1], before[-1]
    if behind:
        yield pa.record_batch([*held.columns, [first], [last]], names=[*held.schema.names, "hub", "before"])


def _sets(size: int):
    """(key, n, tokens) of the texts whose set has the wanted key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            grams, at = shingles(part.column("text"), size)
            n, key = np.diff(at), set_keys(grams, at)
            took = np.flatnonzero((n > 0) & (key == part.column("wanted").to_numpy()))
            yield pa.record_batch(
                [key[took], n[took], pa.array([grams[at[i] : at[i + 1]].tobytes() for i in took], pa.binary())],
                names=["key", "n", "tokens"],
            )

    return run


def _overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the intersection of two sorted token lists, row by row."""
    for batch in batches:
        for part in slices([batch], "tokens_a"):
            both = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(part.column("tokens_a").to_pylist(), part.column("tokens_b").to_pylist(), strict=True)
            ]
            yield pa.record_batch(
                [part.column("a"), part.column("b"), part.column("n_a"), part.column("n_b"), pa.array(both, pa.int64())],
                names=["a", "b", "n_a", "n_b", "both"],
            )


def _compared(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with sizes and overlap; ``left`` and ``right`` hold (key, n, tokens)."""
    a, b = (t.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"tokens_{c}")) for t, c in ((left, "a"), (right, "b")))
    return in_arrow(pairs.join(a, "a").join(b, "b"), _overlaps, "a long, b long, n_a long, n_b long, both long")


def _alike(pairs: DataFrame, sizes: DataFrame, share: int) -> DataFrame:
    """Pairs whose sizes allow a link, with the size of the smaller set."""
    return (
        pairs.join(sizes.toDF("a", "n_a"), "a")
        .join(sizes.toDF("b", "n_b"), "b")
        .withColumn("smaller", F.least("n_a", "n_b"))
        .filter(F.col("smaller") * 100 >= F.greatest("n_a", "n_b") * share)
    )


def _links(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs of sets that link. Pairs of too different sizes are left out before their tokens are read."""
    near = _alike(pairs, sets.select("key", "n"), share).select("a", "b")
    return _compared(near, sets, sets).filter(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * share).select("a", "b")


def _rare(shared: DataFrame, share: int) -> DataFrame:
    """``shared`` without the most frequent tokens of each set, as many as a set can do without. Tokens
    listed as common stay: they are few in a set that isn't made of them."""
    often = shared.groupBy("token").agg(F.count("*").alias("sets"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("sets").desc(), "token"))
    spared = F.expr(f"floor(ceil(n * {share} / 100) / {SPARE})")
    loose = shared.filter("not common").join(often, "token").withColumn("rank", rank).filter(F.col("rank") > spared)
    return loose.select(*shared.columns).unionByName(shared.filter("common"))


def _asked(rows: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    """(a, block): sets and the blocks that can hold a set linked with them, of a later component.
    ``rows``: (token, key, n, place, common, root, shelf); a shelf has all blocks of a group and size."""
    mixed = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
    # of two linked sets the smaller needs a shorter prefix
    short = F.expr(f"place <= n - ceil(2 * n * {share} / {100 + share}) + floor(n / {SPARE})")
    rows = stored(rows.withColumn("short", short).withColumn("rest", F.col("n") - F.col("place")).join(mixed, "token"), "mixed")
    shelves = rows.groupBy("token", F.col("shelf").alias("b")).agg(
        F.max("root").alias("last"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest_b"), F.max("short").alias("short_b")
    )
    least = f"greatest(least, ceil(n * {share} / 100))"
    could = F.expr(
        f"root < last and most * 100 >= n * {share} and least * {share} <= n * 100 "
        "and ((short and most >= n) or (short_b and least <= n)) "
        f"and (not common or (least(rest, rest_b) + floor(n / {SPARE})) * {100 + share} >= (n + {least}) * {share})"
    )
    met = rows.drop("shelf").join(shelves, "token").filter(could).select(F.col("key").alias("a"), "root", F.col("b").alias("shelf")).distinct()
    blocks = nodes.groupBy("shelf", "block").agg(F.max("root").alias("last"))
    return met.join(blocks, "shelf").filter("root < last").select("a", "block")


def _open(share: int):
    """Links between the sets that ask a block and the members of blocks that qualify, one for each
    other component."""

    def run(asking: pa.Table, members: pa.Table) -> pa.Table:
        links: list[tuple[int, int]] = []
        if asking.num_rows and members.num_rows:
            tokens = [np.frombuffer(x, np.uint64) for x in members.column("tokens").to_pylist()]
            n, root, key = (members.column(c).to_numpy() for c in ("n", "root", "key"))
            union, owner = np.concatenate(tokens), np.repeat(np.arange(len(n)), n)
            order = np.argsort(union, kind="stable")
            union, owner = union[order], owner[order]
            fresh = np.append(True, union[1:] != union[:-1])
            columns = (asking.column(c).to_pylist() for c in ("key", "n", "root", "tokens"))
            for a, n_a, root_a, raw in zip(*columns, strict=True):
                mine = np.frombuffer(raw, np.uint64)
                hit = mine[np.minimum(np.searchsorted(mine, union), n_a - 1)] == union
                least = max(int(n.min()), -(-n_a * share // 100))
                if (hit & fresh).sum() * (100 + share) < (n_a + least) * share:
                    continue
                both = np.bincount(owner[hit], minlength=len(n))
                linked = (both * 100 >= (n + n_a - both) * share) & (root > root_a)
                _, one = np.unique(root[linked], return_index=True)
                links += [(a, b) for b in key[linked][one].tolist()]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return run


def _opened(asked: DataFrame, nodes: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The links that the asked blocks hold for the sets that ask them."""
    asks = asked.groupBy("block").agg(F.ceil(F.count("*") / ASKS).cast("long").alias("copies"))
    whole = nodes.select("key", "root", "block").join(sets, "key")
    members = whole.join(asks, "block").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    asking = (
        asked.join(asks, "block")
        .select(F.col("a").alias("key"), "block", F.pmod(F.xxhash64("a"), "copies").alias("copy"))
        .join(whole.drop("block"), "key")
    )
    columns = ["block", "copy", "key", "n", "root", "tokens"]
    ship(asked.sparkSession)
    ours, theirs = (t.select(*(F.col(c).alias(c) for c in columns)).groupBy("block", "copy") for t in (asking, members))
    return ours.cogroup(theirs).applyInArrow(_open(share), "a long, b long")


def link_documents(docs: DataFrame, size: int = SIZE, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(in_arrow(docs, _survey(size), "doc_id long, n long, key long, token long, seen long"), "survey")
    listed = docs.sparkSession.sparkContext.broadcast(_common_list(found.filter("token is not null")))
    keys = found.filter("n is not null").select("doc_id", "n", "key")

    schema = "token long, key long, n long, place long, common boolean, rare long"
    prefixes = in_arrow(docs.filter("doc_id is not null"), _prefixes(size, share, listed), schema)
    by_token = prefixes.repartition("token").sortWithinPartitions("token", "rare", "n", "key")
    shared = stored(in_arrow(by_token, _shared, f"{schema}, hub long, before long"), "shared")
    sizes = shared.select("key", "n").distinct()

    met = shared.select("key", "n", "place", "common", F.explode(F.array_distinct(F.array("hub", "before"))).alias("b")).filter("key <> b")
    met = met.groupBy(F.col("key").alias("a"), "b").agg(
        F.count("*").alias("met"), F.max("common").alias("common"), F.max(F.expr(f"n - place + floor(n / {SPARE})")).alias("rest")
    )
    enough = (F.col("met") > F.floor(F.col("smaller") / SPARE)) | (
        F.col("common") & (F.col("rest") * (100 + share) >= (F.col("n_a") + F.col("n_b")) * share)
    )
    alike = stored(_alike(met, sizes, share), "alike")
    near = alike.filter(enough).select("a", "b")
    sets = _sets_of(docs, keys, near, size)
    roots = components(_links(near, sets, share)).withColumnRenamed("node", "key")

    home = alike.groupBy(F.col("a").alias("key")).agg(F.max(F.struct("met", F.col("b").alias("home"))).getField("home").alias("home"))
    # a component goes where its root's home is, so that what is similar without links is together too
    nodes = sizes.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    nodes = nodes.join(home.withColumnRenamed("key", "root"), "root", "left").join(roots.toDF("home", "of_home"), "home", "left")
    nodes = nodes.withColumn("group", F.coalesce("of_home", "home", "root")).withColumn("class", F.floor(F.log("n") * 20))
    members = nodes.groupBy("group", "class").agg(F.count("*").alias("members"))
    place = F.pmod(F.xxhash64("key"), F.ceil(F.col("members") / BLOCK).cast("long"))
    nodes = nodes.join(members, ["group", "class"]).select(
        "key", "n", "root", F.xxhash64("group", "class").alias("shelf"), F.xxhash64("group", "class", place).alias("block")
    )
    nodes = stored(nodes, "nodes")
    rare = _rare(shared.drop("hub", "before", "rare"), share)
    asked = stored(_asked(rare.join(nodes.drop("n", "block"), "key"), nodes, share), "asked")
    in_blocks = nodes.join(asked.select("block").distinct(), "block", "left_semi").select(F.col("key").alias("a"), F.col("key").alias("b"))
    sets = _sets_of(docs, keys, asked.select("a", F.col("a").alias("b")).unionByName(in_blocks), size)
    edges = roots.toDF("a", "b").unionByName(_opened(asked, nodes, sets, share))
    return _result(keys, components(edges))


def _sets_of(docs: DataFrame, keys: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """(key, n, tokens) of all sets named in ``pairs``, from one text of each."""
    named = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = keys.filter("doc_id is not null").join(named, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    texts = docs.join(wanted.select("doc_id", F.col("key").alias("wanted")), "doc_id")
    return stored(in_arrow(texts, _sets(size), "key long, n long, tokens binary").dropDuplicates(["key"]), "sets")


def _result(keys: DataFrame, roots: DataFrame) -> DataFrame:
    alone = keys.filter("key is null or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    rest = keys.filter("key is not null and doc_id is not null").join(roots.withColumnRenamed("node", "key"), "key", "left")
    rest = rest.select("doc_id", "n", F.coalesce("root", "key").alias("root"))
    least = rest.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rest.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))


def drop_linked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest doc_id stays; rows without doc_id
    stay, and so does every other row that links with nothing. Of rows with one doc_id that stays, equal texts
    count once and different ones all stay: nothing tells which of them is the document."""
    found = link_documents(docs)
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    rows = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn("__text", F.xxhash64("text"))
    one = rows.dropDuplicates(["doc_id", "__text"])  # dealt by doc_id already
    return docs.filter("doc_id is null").unionByName(one.drop("__text")).select(*docs.columns)
