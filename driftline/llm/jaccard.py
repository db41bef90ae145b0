"""Documents whose sets of word shingles are nearly equal: grouped prefix join and components.

1. Shingles are put in one order for all documents, rare ones first; how often
   they occur is summed over all documents in a table of fixed size by their hash.
2. Documents with the same set are one from here on. Sets of the same size and
   prefix are one group. Two sets that are similar enough share a shingle of
   their prefixes, so only groups that do are looked at.
3. Pairs are filtered by size, by the place of the shared shingle, and by a
   sketch of a set whose bits say how many of its shingles fall in each slot, odd
   or even: sets differ in at least as many shingles as sketches differ in bits.
4. Centre pairs: members with the least member of their group, groups with the
   least group at each prefix shingle. That is linear in the prefixes. Whatever
   passes the filters is taken to belong together for the time being, and ties
   copies together, however many there are.
5. Rest pairs: whatever shares a prefix shingle or a group and is not tied
   together; group pairs are filtered, then expanded to their members. A shingle
   whose groups are all tied together makes no pair at all.
6. All pairs are verified on the whole sets. Where a tie does not hold, the pairs
   within it that it kept from being made are made and verified as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.components import components
from driftline.llm.files import kept
from driftline.llm.shingles import in_use, shingle_set
from driftline.operators.joins import lookup_join

SLOT_BITS = 18
CHUNK = 1024
SKETCH_BITS = 1024


def slot_counts(docs: DataFrame, length: int, slot_bits: int = SLOT_BITS) -> np.ndarray:
    """How many sets have a shingle in each of ``2**slot_bits`` slots of the hash, over all texts.

    A task sums its own texts; the slots of all tasks are summed in chunks. The
    table has the same size for any corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        total = np.zeros(1 << slot_bits, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(total, shingle_set(text.as_py(), length) >> np.uint64(64 - slot_bits), 1)
        chunks = [c.tobytes() for c in total.reshape(-1, min(CHUNK, len(total)))]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int64()), pa.array(chunks, pa.binary())], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["chunk", "counts"]
        )

    schema = "chunk bigint, counts binary"
    summed = docs.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    total = np.zeros(1 << slot_bits, np.int64)
    for row in summed.collect():
        part = np.frombuffer(row["counts"], np.int64)
        total[row["chunk"] * len(part) : (row["chunk"] + 1) * len(part)] = part
    return total


def prefix_length(size: int, percent: int) -> int:
    """A set with a shingle outside its first so many cannot miss all of them in a similar set's first ones."""
    return size - -(-percent * size // 100) + 1


def signed(docs: DataFrame, counts: np.ndarray, length: int, percent: int, slot_bits: int = SLOT_BITS) -> DataFrame:
    """``doc_id, sum, size, set_key, prefix_key, prefix, sketch`` of every document.

    Keys are 128-bit digests. A set too small to be similar to any other has no prefix.
    """
    slots = docs.sparkSession.sparkContext.broadcast(counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        often = slots.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes, set_keys, prefix_keys, prefixes, sketches = [], [], [], [], []
                for text in part.column("text"):
                    shingles = shingle_set(text.as_py(), length)
                    n = len(shingles)
                    sizes.append(n)
                    set_keys.append(xxhash.xxh128_digest(shingles.tobytes()))
                    if n * (100 - percent) >= percent:
                        order = np.argsort(often[shingles >> np.uint64(64 - slot_bits)], kind="stable")
                        prefix = shingles[order[: prefix_length(n, percent)]]
                        prefixes.append(prefix.view(np.int64))
                        prefix_keys.append(xxhash.xxh128_digest(prefix.tobytes()))
                        odd = np.bincount((shingles & np.uint64(SKETCH_BITS - 1)).view(np.int64), minlength=SKETCH_BITS) & 1
                        sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                    else:
                        prefixes.append(None)
                        prefix_keys.append(None)
                        sketches.append(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("sum"),
                        pa.array(sizes, pa.int64()),
                        pa.array(set_keys, pa.binary()),
                        pa.array(prefix_keys, pa.binary()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                        pa.array(sketches, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "sum", "size", "set_key", "prefix_key", "prefix", "sketch"],
                )

    return docs.mapInArrow(sign, "doc_id bigint, sum bigint, size bigint, set_key binary, prefix_key binary, prefix array<bigint>, sketch array<bigint>")


def whole_sets(docs: DataFrame, length: int) -> DataFrame:
    """``set_key, shingles`` of documents."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [shingle_set(text.as_py(), length) for text in part.column("text")]
                keys = [xxhash.xxh128_digest(shingles.tobytes()) for shingles in sets]
                lists = pa.array([shingles.view(np.int64) for shingles in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), lists], ["set_key", "shingles"])

    return docs.mapInArrow(read, "set_key binary, shingles array<bigint>")


def similar(shared: Column, left: Column, right: Column, percent: int) -> Column:
    return 100 * shared >= percent * (left + right - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar. A node in very many pairs may be split by adaptive execution."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    shared = F.size(F.array_intersect("left", "right"))
    return joined.filter(similar(shared, F.size("left"), F.size("right"), percent)).select("a", "b")


def _sizes_fit(left: Column, right: Column, percent: int) -> Column:
    return (100 * left >= percent * right) & (100 * right >= percent * left)


def sketched(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of different nodes whose sizes and sketches allow similarity, the lesser node first."""
    ordered = pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = members.select(F.col("node").alias("a"), F.col("size").alias("left"), F.col("sketch").alias("bits"))
    right = members.select(F.col("node").alias("b"), F.col("size").alias("right"), F.col("sketch").alias("others"))
    apart = F.aggregate(F.zip_with("bits", "others", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)
    joined = ordered.join(left.hint("merge"), "a").join(right.hint("merge"), "b").filter(_sizes_fit(F.col("left"), F.col("right"), percent))
    return joined.filter((100 + percent) * apart <= (100 - percent) * (F.col("left") + F.col("right"))).select("a", "b")


def _place_fits(x: str, y: str, percent: int) -> Column:
    """Whether two postings of one shingle can be those of the first shared one: it and all after it must be enough."""
    left, right = F.col(f"{x}.size"), F.col(f"{y}.size")
    still = F.least(left - F.col(f"{x}.place"), right - F.col(f"{y}.place"))
    return _sizes_fit(left, right, percent) & similar(still, left, right, percent)


def rest_pairs(hits: DataFrame, members: DataFrame, ties: DataFrame, percent: int, *, within: bool = False) -> DataFrame:
    """Pairs ``a, b`` of members that share a prefix shingle or a group and are not tied together.

    ``ties`` has ``node, tie``; nodes it lacks are tied to nothing. With ``within``
    it has ``guess`` as well, and only nodes of one guess are paired. At each
    shingle the units, the parts of groups tied together, of the largest tie are
    met by all others, never by each other.
    """
    guess = ["guess"] if within else []
    placed = members.select("node", "size", "grp").join(ties, "node", "inner" if within else "left").withColumn("tie", F.coalesce("tie", "node"))
    placed = placed.join(placed.groupBy("grp", "tie", *guess).agg(F.min("node").alias("unit")), ["grp", "tie", *guess])
    placed = kept(placed, "units")
    units = placed.filter("node = unit").select("unit", "grp", "tie", "size", *guess)
    in_group = units.select(F.xxhash64(F.lit("group"), "grp").alias("shingle"), F.lit(0).alias("place"), "size", "unit", "tie", *guess)
    met = hits.select("shingle", "place", "grp", "size").join(units.drop("size"), "grp").drop("grp").unionByName(in_group)
    key = ["shingle", *guess]
    counted = met.groupBy(*key, "tie").agg(F.count(F.lit(1)).alias("n"))
    open_keys = counted.groupBy(*key).agg(F.count(F.lit(1)).alias("ties"), F.max(F.struct("n", "tie")).alias("top")).filter("ties > 1")
    met = kept(met.join(open_keys.select(*key, F.col("top.tie").alias("main")), key), "open-postings")
    x, y = met.filter("tie != main").alias("x"), met.alias("y")
    same = [F.col(f"x.{name}") == F.col(f"y.{name}") for name in key]
    ahead = (F.col("x.tie") != F.col("y.tie")) & _place_fits("x", "y", percent)
    unit_pairs = x.join(y, [*same, ahead]).select(F.least("x.unit", "y.unit").alias("a"), F.greatest("x.unit", "y.unit").alias("b")).distinct()
    of_unit = placed.select("unit", "node")
    return (
        unit_pairs.join(of_unit.select(F.col("unit").alias("a"), F.col("node").alias("left")), "a")
        .join(of_unit.select(F.col("unit").alias("b"), F.col("node").alias("right")), "b")
        .select(F.col("left").alias("a"), F.col("right").alias("b"))
    )


def text_sum(id_col: str, text_col: str) -> Column:
    """A hash of a row's id and text. It only finds rows again; what is found is compared by more."""
    return F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col))


def numbered(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with ``row``, a number of its own for each: its id where no other row has it, else one that is no id.

    Centres are the least numbers, and what came first is likeliest what the others were copied from.
    """
    twice = ids.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = kept(twice.select("doc_id", F.lit(True).alias("twice")), "ids-given-twice")
    low, high = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    placed = lookup_join(rows, twice, "doc_id").withColumn("place", F.monotonically_increasing_id())
    if high is None or (high >= 1 << 62 and low <= -(1 << 62)):
        return placed.withColumn("row", F.col("place")).drop("place", "twice")
    other = F.lit(high) + 1 + F.col("place") if high < 1 << 62 else F.lit(low) - 1 - F.col("place")
    alone = F.col("doc_id").isNotNull() & F.col("twice").isNull()
    return placed.withColumn("row", F.when(alone, F.col("doc_id")).otherwise(other)).drop("place", "twice")


def linked_rows(docs: DataFrame, *, length: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, sum, n_shingles, component`` of every row, stored.

    ``row`` is a number of its own for each row, ``sum`` the ``text_sum`` of it.
    ``component`` is equal for rows that are linked, whatever their ids: NULL ids,
    equal ids with different texts and rows given twice are rows like any other.
    Rows without words have components of their own.
    """
    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), text_sum(id_col, text_col).alias("sum"))
    counts = slot_counts(named, length)
    # Numbers are stored with the rows, so they stay the same.
    rows = kept(numbered(signed(named, counts, length, percent), named.select("doc_id")), "signed")

    # Equal sets are one node, named by the first row.
    nodes = kept(rows.filter("size > 0").groupBy("set_key").agg(F.min("row").alias("node")), "nodes")
    one_each = rows.filter("prefix_key IS NOT NULL").join(nodes.select(F.col("node").alias("row"), "set_key"), ["row", "set_key"])
    grouped = one_each.groupBy("size", "prefix_key").agg(F.min("row").alias("grp"))
    members = one_each.select(F.col("row").alias("node"), "sum", "size", "prefix_key", "sketch").join(grouped, ["size", "prefix_key"])
    members = kept(members.drop("prefix_key"), "members")

    # Postings of the groups, kept where a shingle has two or more.
    first = members.filter("node = grp").select(F.col("node").alias("row"))
    firsts = rows.filter("prefix IS NOT NULL").select("row", "size", "prefix").join(first.hint("merge"), "row", "left_semi")
    posted = firsts.select(F.posexplode("prefix").alias("place", "shingle"), F.col("row").alias("grp"), F.col("size").cast("int").alias("size"))
    shared = posted.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("shingle")
    met = kept(posted.join(shared.hint("merge"), "shingle"), "met")
    least = met.groupBy("shingle").agg(F.min("grp").alias("centre"))
    hits = kept(met.join(least.hint("merge"), "shingle"), "postings")

    # Centre pairs, and what they tie together for the time being.
    centres = hits.filter("grp = centre").alias("y")
    others = hits.filter("grp != centre").alias("x")
    met = others.join(centres, (F.col("x.shingle") == F.col("y.shingle")) & _place_fits("x", "y", percent))
    in_group = members.filter("node != grp").select(F.col("grp").alias("a"), F.col("node").alias("b"))
    centred = kept(
        sketched(in_group.unionByName(met.select(F.col("y.grp").alias("a"), F.col("x.grp").alias("b"))), members, percent), "centre-pairs"
    )
    guesses = components(centred)
    more = sketched(rest_pairs(hits, members, guesses.withColumnRenamed("component", "tie"), percent), members, percent)
    pairs = kept(centred.unionByName(more).distinct(), "pairs")

    # Whole sets of what is in a pair, from the texts that have its sum.
    involved = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(members.select("node", "sum"), "node")
    involved = kept(involved.join(nodes, "node"), "involved")
    texts = named.join(involved.select("sum").distinct().hint("merge"), "sum", "left_semi")
    sets = whole_sets(texts, length).join(involved.select("node", "set_key").hint("merge"), "set_key").select("node", "shingles")
    sets = kept(sets.dropDuplicates(["node"]), "sets")
    links = kept(verified(pairs, sets, percent), "links")
    held = components(links)

    # Ties that do not hold: their nodes are in centre pairs, so their sets are there.
    real = guesses.withColumnRenamed("component", "guess").join(held.withColumnRenamed("component", "tie"), "node", "left")
    real = real.withColumn("tie", F.coalesce("tie", "node"))
    broken = real.groupBy("guess").agg(F.min("tie").alias("low"), F.max("tie").alias("high")).filter("low < high").select("guess")
    real = kept(real.join(broken, "guess", "left_semi"), "broken")
    if not real.isEmpty():
        missed = sketched(rest_pairs(hits, members, real, percent, within=True), members, percent)
        held = components(links.unionByName(verified(missed, sets, percent)))

    of_set = nodes.join(held, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    result = rows.select("row", "doc_id", "sum", "size", "set_key").join(of_set, "set_key", "left")
    component = F.coalesce("component", "row").alias("component")
    return kept(result.select("row", "doc_id", "sum", F.col("size").alias("n_shingles"), component), "linked")


def near_duplicates(docs: DataFrame, *, length: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` of every row.

    Two rows are linked if the intersection of their sets of ``length``-word
    shingles is at least ``percent`` hundredths of the union; the component is the
    least id reachable over links. Rows without words are linked with nothing.
    Rows with one id are looked at each for itself, and so are rows without an id;
    those have a NULL component. Ties do not occur: equal sets are one set. Other
    columns are not looked at.
    """
    linked = linked_rows(docs, length=length, percent=percent, id_col=id_col, text_col=text_col)
    # Where nothing is linked, the row's own id is the least.
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    named = linked.join(least, "component", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    return named.select(F.col("doc_id").alias(id_col), "n_shingles", component)


def one_of_each(docs: DataFrame, *, length: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, of linked ones just one: that with the least id, known ids first.

    Rows are told apart by themselves, not by their ids: where two texts share an
    id, one of them may go and the other stay. Of rows with the same id and text
    any one stays. Rows without words are linked with nothing and all stay. The
    columns are those of ``docs``, whatever their names.
    """
    linked = linked_rows(docs, length=length, percent=percent, id_col=id_col, text_col=text_col)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "sum", "row")
    chosen = linked.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).filter("n > 1")
    marked = linked.join(chosen.select("component", F.col("first.row").alias("first")), "component")
    # Rows of one id and text stand or fall together, but for those given twice.
    texts = marked.groupBy("doc_id", "sum").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("row") == F.col("first")).alias("stays"))
    texts = kept(texts.filter("n > 1 OR NOT stays"), "copies")
    left = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("bigint").alias("id"), text_sum(id_col, text_col).alias("sum")).alias("d")

    def same(of: str) -> Column:
        return (F.col("d.sum") == F.col(f"{of}.sum")) & F.col("d.id").eqNullSafe(F.col(f"{of}.doc_id"))

    alone = left.join(texts.alias("t").hint("merge"), same("t"), "left_anti")
    again = left.join(texts.filter("stays").alias("s").hint("merge"), same("s"), "left_semi").dropDuplicates(["id", "sum"])
    return alone.select("doc.*").unionByName(again.select("doc.*"))
