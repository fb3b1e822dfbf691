"""Near duplicates: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets.

A signature has ``CHUNKS * SLOTS`` values of 16 bits; its distance from another is the number of
values that differ. Two signatures of distance ``CHUNKS * (ERRORS + 1) - 1`` or less must agree in
all but ``ERRORS`` values of some chunk (pigeonhole). Every chunk is therefore indexed once for
each choice of the values that may be wrong, and a pair within that distance meets in a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statera.llm.common import bound
from statera.llm.shingles import WordHashes, lowered_words, mixed, shingle_set
from statera.session import stored

CHUNKS, SLOTS, ERRORS = 6, 4, 1
#: Every pair at this distance or less meets in a bucket.
DISTANCE = CHUNKS * (ERRORS + 1) - 1
CHUNK_COLUMNS = [f"__c{i}" for i in range(CHUNKS)]
#: Two alike sets share one of their rarest few shingles; so many times as many are looked at, which
#: tells most sets apart that are only somewhat alike.
DEPTH = 2
#: Members of a block of a bucket; pairs of blocks are compared apart.
BLOCK = 1024


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return drawn[:n] | np.uint64(1), drawn[n:]


_FACTORS, _SHIFTS = _permutations(CHUNKS * SLOTS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The lowest 16 bits of every MinHash, four in a 64-bit number, most significant first."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    bits = (least & np.uint64(0xFFFF)).reshape(CHUNKS, SLOTS)
    packed = np.zeros(CHUNKS, np.uint64)
    for k in range(SLOTS):
        packed = (packed << np.uint64(16)) | bits[:, k]
    return packed.view(np.int64)


def set_name(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets of shingles apart."""
    if not len(shingles):
        return b""
    parts = [mixed(shingles ^ np.uint64(seed)) for seed in (0x243F6A8885A308D3, 0x13198A2E03707344)]
    return b"".join(int(part.sum(dtype=np.uint64)).to_bytes(8, "big") for part in parts)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        names, sizes, signatures = [], [], []
        for text in batch.column(1):
            found = shingle_set(lowered_words(text.as_py()), hashes)
            names.append(set_name(found))
            sizes.append(len(found))
            signatures.append(signature(found))
        chunks = np.array(signatures, np.int64).reshape(-1, CHUNKS)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(names, pa.binary()),
                *[pa.array(np.ascontiguousarray(chunks[:, i])) for i in range(CHUNKS)],
            ],
            names=["id", "n", "name", *CHUNK_COLUMNS],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # sets are larger than texts
            nodes, found = [], []
            for node, name, text in zip(*(column.slice(at, 256) for column in batch.columns)):
                one = shingle_set(lowered_words(text.as_py()), hashes)
                # A repeated id may bring texts of other nodes.
                if set_name(one) == name.as_py():
                    nodes.append(node.as_py())
                    found.append(one)
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                names=["node", "shingles"],
            )


def _bucket_keys() -> Column:
    """One key for each chunk and each value of it that may be wrong: the other values."""
    keys = []
    for i, column in enumerate(CHUNK_COLUMNS):
        for wrong in range(SLOTS):
            low = 16 * (SLOTS - 1 - wrong)
            above = F.shiftrightunsigned(F.shiftrightunsigned(F.col(column), low), 16)
            above = F.shiftleft(above, low)
            below = F.col(column).bitwiseAND(F.lit((1 << low) - 1))
            rest = above.bitwiseOR(below).bitwiseAND(F.lit((1 << 48) - 1))
            keys.append(rest.bitwiseOR(F.lit((i * SLOTS + wrong) << 48)))
    return F.array(*keys)


def _wrong(left: str, right: str, column: str) -> Column:
    """A bit for each value of a chunk that differs, the lowest of the value's sixteen."""
    x = F.col(f"{left}.{column}").bitwiseXOR(F.col(f"{right}.{column}"))
    for step in (8, 4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, step))
    return x.bitwiseAND(F.lit(0x0001000100010001))


def _distance(left: str, right: str) -> Column:
    """In how many values two signatures differ."""
    total = F.lit(0)
    for column in CHUNK_COLUMNS:
        total = total + F.bit_count(_wrong(left, right, column))
    return total


def _first_bucket(left: str, right: str, key: Column) -> Column:
    """Whether ``key`` is the first of all keys that two signatures share, so a pair counts once."""
    first = F.lit(None).cast("bigint")
    for i, column in reversed(list(enumerate(CHUNK_COLUMNS))):
        wrong = _wrong(left, right, column)
        choice = F.when(wrong == 0, i * SLOTS)
        for k in range(SLOTS):
            choice = choice.when(wrong == 1 << 16 * (SLOTS - 1 - k), i * SLOTS + k)
        first = F.coalesce(choice, first)
    return F.shiftrightunsigned(key, 48) == first


def _may_link(left: str, right: str, percent: int) -> Column:
    """Whether two sets can be alike by their sizes; how far signatures differ does not count."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Nodes take the smallest root of their neighbours, then their root's root, until nothing
    changes. Each round is a written table; minima are pre-aggregated in every task.
    """
    both = stored(
        links.select(F.col(a).alias("src"), F.col(b).alias("dst"))
        .union(links.select(F.col(b), F.col(a)))
        .distinct(),
        "links",
    )
    roots = stored(
        both.groupBy("src").agg(F.min("dst").alias("dst")).select(
            F.col("src").alias("node"), F.least("src", "dst").alias("root")
        ),
        "roots",
    )
    while True:
        near = (
            both.join(roots.withColumnRenamed("node", "dst"), "dst")
            .groupBy("src")
            .agg(F.min("root").alias("near"))
        )
        lower = roots.join(near, roots["node"] == near["src"]).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        far = roots.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        fresh = stored(
            lower.join(far, "root", "left").select(
                "node", F.least("root", F.coalesce("beyond", "root")).alias("root"), "old"
            ),
            "roots",
        )
        roots = fresh.select("node", "root")
        if fresh.filter(F.col("root") != F.col("old")).isEmpty():
            return roots


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    star_rounds: int = 2,
) -> DataFrame:
    """(id, n_shingles, component_id, kept): linked documents, by sets of five-word shingles.

    Documents are linked if ``100 * common >= percent * union``. The guarantee of the index is for
    signatures up to ``DISTANCE``; of pairs at 85 % about two in a million, and at 80 % 35 in a
    million, lie further apart in every chunk. Whatever the index proposes is confirmed on the whole
    sets, unless the sizes or the rarest shingles rule it out, which is exact.

    Equal sets are one node from the start, however many documents hold them. Buckets never give
    all their pairs: first every member is compared with one hub of its bucket, ``star_rounds``
    times, and confirmed links make components. Only pairs of different components that are left
    are then compared, in pairs of blocks of a bucket, and of these only those are confirmed that
    their rarest shingles allow; so the outcome is the same as if all pairs had been. Texts are read twice, the second time only those of nodes that share a bucket.

    Null texts and texts without words have an empty set and are linked with nothing. Shorter
    texts are one shingle. Repeated rows are copies of each other. The component of rows whose ids
    are null is the smallest id that is not, or null. An empty table gives an empty result. Only
    the two named columns are read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    chunk_types = ", ".join(f"{column} bigint" for column in CHUNK_COLUMNS)
    signed = stored(
        docs.mapInArrow(_signed, f"id {id_type}, n bigint, name binary, {chunk_types}"), "signed"
    )
    first = {column: F.first(column).alias(column) for column in ("n", *CHUNK_COLUMNS)}
    nodes = stored(
        signed.filter("n > 0")
        .groupBy("name")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), *first.values())
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    roots = _linked(docs, nodes, percent, star_rounds)
    grouped = nodes.join(roots, "node", "left").select(
        "name", "id", "copies", F.coalesce("root", "node").alias("root"),
        F.col("root").isNotNull().alias("linked"),
    )
    smallest = (
        grouped.filter(F.col("linked")).groupBy("root").agg(F.min("id").alias("least"))
    )
    # Only sets of several documents have to be looked up.
    changed = (
        grouped.filter(F.col("linked") | (F.col("copies") > 1))
        .join(smallest, "root", "left")
        .select("name", F.coalesce("least", "id").alias("component_id"), F.lit(True).alias("met"))
    )
    component = F.when(F.col("met"), F.col("component_id")).otherwise(F.col("id"))
    return (
        signed.select("id", "n", "name")
        .join(changed, "name", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
    )


def _linked(docs: DataFrame, nodes: DataFrame, percent: int, star_rounds: int) -> DataFrame:
    """(node, root) of all nodes with a link."""
    keyed = nodes.select("node", F.explode(_bucket_keys()).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = stored(keyed.join(sizes, "key"), "buckets")
    central = buckets.groupBy("node").agg(F.sum("members").alias("central"))
    sharing = stored(nodes.drop("copies").join(central, "node"), "sharing")
    sets = _sharing_sets(docs, sharing)

    roots = sharing.select("node", F.col("node").alias("root")).limit(0)
    links = None
    for turn in range(star_rounds + 1):
        members = stored(_members(buckets, sharing, roots), "members")
        if turn < star_rounds:
            pairs = _star_pairs(members, sharing, turn, percent)
        else:
            pairs = _rest_pairs(members, sharing, _rarest(members, sets, percent), percent)
        confirmed = stored(_confirmed(pairs, sets, percent), "confirmed")
        if not confirmed.isEmpty():
            links = confirmed if links is None else links.union(confirmed)
            roots = components(links)
    return roots


def _members(buckets: DataFrame, sharing: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root, rank) of the members of buckets that hold several components.

    ``rank`` is how many nodes the component has, and then how central the node is.
    """
    sized = roots.join(roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "root")
    rank = F.struct(
        F.coalesce("size", F.lit(1)).alias("size"), F.col("central").alias("central")
    )
    ranked = sharing.join(sized, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), rank.alias("rank")
    )
    members = buckets.select("key", "node").join(ranked, "node")
    split = members.groupBy("key").agg(
        (F.min("root") != F.max("root")).alias("split"), F.count(F.lit(1)).alias("members")
    )
    return members.join(split.filter("split").drop("split"), "key")


def _sharing_sets(docs: DataFrame, sharing: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes that share a bucket, from one document of each."""
    wanted = sharing.select("node", "name", F.col("id").alias("of"))
    read = docs.join(wanted, docs["id"].eqNullSafe(wanted["of"])).select("node", "name", "text")
    return stored(read.mapInArrow(_sets, "node bigint, shingles array<bigint>"), "sets")


def _star_pairs(members: DataFrame, sharing: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member with the hub of its bucket, unless a link has joined them already.

    The hub is a member of the bucket's largest component: at first, when every component is one
    node, the member that meets most others in all its buckets; later one by chance.
    """
    chance = F.xxhash64("node", "key", F.lit(turn))
    order = F.col("rank.central") if turn == 0 else chance
    best = F.struct(
        F.col("rank.size").alias("size"),
        F.when(F.lit(turn > 0), F.col("root")).alias("of"),
        order.alias("order"),
        F.col("node").alias("hub"),
        F.col("root").alias("hub_root"),
    )
    hubs = (
        members.groupBy("key")
        .agg(F.max(best).alias("best"))
        .select("key", "best.hub", "best.hub_root")
    )
    pairs = (
        members.join(hubs, "key")
        .filter((F.col("root") != F.col("hub_root")) & (F.col("node") != F.col("hub")))
        .select("node", "hub")
        .distinct()
    )
    left, right = sharing.alias("l"), sharing.alias("r")
    return (
        pairs.join(left, F.col("l.node") == pairs["node"])
        .join(right, F.col("r.node") == pairs["hub"])
        .filter(_may_link("l", "r", percent))
        .select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b"))
        .distinct()
    )


def _rarest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, rare): the rarest shingles of each member, ``DEPTH`` times as many as two alike sets
    cannot both miss. Sorted by how many members hold them, then by hash: one order for all sets.
    """
    nodes = members.select("node").distinct()
    cells = sets.join(nodes, "node", "left_semi").select("node", F.explode("shingles").alias("s"))
    held = cells.groupBy("s").agg(F.count(F.lit(1)).alias("held"))
    ordered = F.sort_array(F.collect_list(F.struct("held", "s")))
    n = F.count(F.lit(1))
    most = (DEPTH * (n - F.ceil(n * percent / 100) + 1)).cast("int")
    return stored(
        cells.join(held, "s")
        .groupBy("node")
        .agg(F.slice(ordered, 1, most)["s"].alias("rare")),
        "rare",
    )


def _may_overlap(left: str, right: str, percent: int) -> Column:
    """Whether two sets can have enough in common, by their rarest shingles.

    Behind the last rare shingle that both have, they share no more than what the shorter rest
    holds; without a common one they cannot be alike.
    """
    a, b = F.col(f"{left}.rare"), F.col(f"{right}.rare")
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")

    def enough(common: Column) -> Column:
        last = F.element_at(common, -1)
        rest = F.least(n - F.array_position(a, last), m - F.array_position(b, last))
        return (F.size(common) > 0) & (
            (100 + percent) * (F.size(common) + rest) >= percent * (n + m)
        )

    return bound(F.array_intersect(a, b), lambda c: F.when(F.size(c) > 0, enough(c)).otherwise(False))


def _rest_pairs(
    members: DataFrame, sharing: DataFrame, rarest: DataFrame, percent: int
) -> DataFrame:
    """The pairs of a bucket whose members are still in different components.

    A bucket's members are dealt to blocks, and every two blocks meet in a group of their own; of
    a group only the pairs come out that can overlap enough by size and rarest shingles.
    """
    blocks = F.ceil(F.col("members") / F.lit(BLOCK))
    full = (
        members.select("key", "node", "root", blocks.alias("blocks"))
        .join(sharing.select("node", "n", *CHUNK_COLUMNS), "node")
        .join(rarest, "node")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = full.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select(
        "key", low.alias("x"), high.alias("y"), "own", "node", "root", "n", "rare", *CHUNK_COLUMNS
    )
    left, right = dealt.alias("l"), dealt.alias("r")
    meet = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("key", "x", "y")]
    apart = (F.col("l.node") < F.col("r.node")) & (F.col("l.root") != F.col("r.root"))
    once = (F.col("l.x") == F.col("l.y")) | (F.col("l.own") != F.col("r.own"))
    alike = _may_link("l", "r", percent) & _first_bucket("l", "r", F.col("l.key"))
    return left.join(
        right, [*meet, apart & once & alike & _may_overlap("l", "r", percent)]
    ).select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are alike enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    together = F.size("left") + F.size("right")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter((100 + percent) * common >= percent * together)
        .select("a", "b")
    )


def keyed_rows(docs: DataFrame, key: str, id_col: str = "doc_id") -> DataFrame:
    """``docs`` as a written table, with a key for every row: in order of the id, null ids last."""
    own = F.struct(
        F.col(id_col).isNull().alias("none"),
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(docs.withColumn(key, own), "keyed")


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, one for each id.

    Where ids are null or repeated, use the key of ``keyed_rows`` as the id in both calls.
    """
    kept = found.filter("kept").select(F.col(id_col).alias("__id")).distinct()
    rows = docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    of_id = Window.partitionBy(id_col).orderBy(F.xxhash64(*docs.columns))
    return rows.withColumn("__nth", F.row_number().over(of_id)).filter("__nth = 1").drop("__nth")
