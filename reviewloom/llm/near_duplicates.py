"""Near duplicates: MinHash signatures and a multi-index Hamming join.

The signature of a document's set of word shingles has 60 symbols of 16 bits, in 10 chunks of 6. If two
signatures differ in at most 19 symbols, then by the pigeonhole principle some chunk differs in at
most one: each chunk is therefore listed six times, each time with another symbol left out, and two
documents meet wherever such a listing agrees. So every pair within a signature distance of 19 meets, and a pair of
similarity 0.8, whose distance is 12 on average, misses all ten chunks with a probability below 3e-5.

Documents with equal sets are one node from the start. Where nodes meet, no list of pairs is made: every node
is compared with one node there that meets most others (the original of a group, as a rule) and with the smallest. Only
listings whose nodes are still in different components after that are looked at further, and only across
components, in blocks that carry the full sets: there a pair is looked at only while its two nodes are apart, its sets are
intersected in place, and a link leaves the block only if it joins what was apart in it. So a block gives fewer links than it has
nodes. Links of both kinds are confirmed on the full sets.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.components import connected
from reviewloom.llm.staging import staged
from reviewloom.llm.textbytes import mix, ragged, slices, word_hashes

CHUNKS, CHUNK_SYMBOLS = 10, 6
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
FAR_BITS = 17  # of 60 one-bit symbols; 6 differ on average at similarity 0.8, with a deviation of 2.3
FAR_IN_BLOCK = 21  # in blocks, where a pair has no other chance
BLOCK_ROWS, BLOCK_BYTES = 2048, 16_000_000
SHINGLES_AT_ONCE = 2_000_000
_ODD = np.random.default_rng(20).integers(0, 2**64, (2, SYMBOLS), dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and where each text's begin.

    A shingle is ``words`` words in a row; a text of fewer words is one shingle, one of none has none.
    """
    keys, first = word_hashes(texts)
    n_words = np.diff(first)
    n = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    text = np.repeat(np.arange(len(n_words)), n)
    before = np.cumsum(n) - n
    at = np.arange(len(text)) - before[text] + first[:-1][text]
    hashes = np.zeros(len(text), np.uint64)
    for k in range(words):
        there = at + k < first[1:][text]
        step = hashes[there] * np.uint64(0xD6E8FEB86659FD93) + keys[at[there] + k] + np.uint64(1)
        hashes[there] = mix(step)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(n_words) + 1))


def _described(texts: pa.Array, words: int) -> pa.StructArray:
    """Size, fingerprint, chunk listings and one-bit signature of each set."""
    sets, first = shingle_sets(texts, words)
    size = np.diff(first)
    full = np.flatnonzero(size)
    least = np.zeros((len(size), SYMBOLS), np.uint64)
    prints = np.zeros((len(size), 2), np.uint64)
    if len(full):
        begins = first[:-1][full]
        prints[full, 0] = np.add.reduceat(sets, begins)
        prints[full, 1] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), begins)
        for k in range(SYMBOLS):
            # the high half of a product by an odd number, then a fold, orders the set anew
            turned = sets * _ODD[0, k]
            turned ^= turned >> np.uint64(32)
            turned *= _ODD[1, k]
            least[full, k] = np.minimum.reduceat(turned, begins)
    symbols = mix(least + _ODD[0]) & np.uint64(0xFFFF)
    bits = (mix(least ^ _ODD[1]) >> np.uint64(63)) << np.arange(SYMBOLS, dtype=np.uint64)
    listed = _listings(symbols.reshape(len(size), CHUNKS, CHUNK_SYMBOLS))
    return pa.StructArray.from_arrays(
        [
            pa.array(size.astype(np.int64)),
            pa.array([row.tobytes() for row in prints], pa.binary()),
            pa.array(list(listed.view(np.int64)), pa.list_(pa.int64())),
            pa.array(bits.sum(axis=1, dtype=np.uint64).view(np.int64)),
        ],
        names=["size", "print", "listed", "bits"],
    )


def _listings(chunks: np.ndarray) -> np.ndarray:
    """Keys of every chunk of every signature, each without one of its symbols."""
    listed = np.empty(chunks.shape, np.uint64)
    for left_out in range(CHUNK_SYMBOLS):
        key = np.full(chunks.shape[:2], left_out, np.uint64)
        key += np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK_SYMBOLS)
        for k in range(CHUNK_SYMBOLS):
            if k != left_out:
                key = mix(key * np.uint64(0xD6E8FEB86659FD93) + chunks[:, :, k].astype(np.uint64))
        listed[:, :, left_out] = key
    return listed.reshape(len(chunks), -1)


def _sets(words: int):
    """Sorted distinct shingle hashes."""

    @F.arrow_udf("binary")
    def sets(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts):
            hashes, first = shingle_sets(part, words)
            raw, bounds = hashes.tobytes(), (first * 8).tolist()
            out += [raw[b:e] for b, e in zip(bounds, bounds[1:], strict=False)]
        return pa.array(out, pa.binary())

    return sets


def described(text: Column, words: int) -> Column:
    @F.arrow_udf("struct<size:long,print:binary,listed:array<long>,bits:long>")
    def of(texts: pa.Array) -> pa.Array:
        parts = [_described(part, words) for part in slices(texts)]
        return pa.concat_arrays(parts) if parts else _described(texts, words)

    return of(text)


def _similar(words: int, percent: int):
    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(left), 200):
            a, b = left.slice(i, 200), right.slice(i, 200)
            (sets_a, first_a), (sets_b, first_b) = shingle_sets(a, words), shingle_sets(b, words)
            pair_a = np.repeat(np.arange(len(a)), np.diff(first_a))
            pair_b = np.repeat(np.arange(len(b)), np.diff(first_b))
            pairs, hashes = np.concatenate([pair_a, pair_b]), np.concatenate([sets_a, sets_b])
            order = np.lexsort((hashes, pairs))
            pairs, hashes = pairs[order], hashes[order]
            twice = (pairs[1:] == pairs[:-1]) & (hashes[1:] == hashes[:-1])
            both = np.bincount(pairs[1:][twice], minlength=len(a))
            either = np.diff(first_a) + np.diff(first_b) - both
            out.append(100 * both >= percent * either)
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return similar


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: list[str] | None = None,
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``row`` (all columns of ``df``, or those of ``carry``, the id among them), ``n_shingles``, ``component_id``
    (the smallest id of all rows that links lead to), ``kept`` (the row has that id) and ``first`` (of all rows that links lead to,
    the one row with the smallest id, null last, and of these the first that was read).

    Links join rows of which the shingle sets have a Jaccard similarity of ``percent`` / 100 or more. Words are runs
    of other than ASCII blanks, A-Z in lower case. Null and blank texts have no shingle and no link: their component
    is their own id. Rows without an id take part; a component of such rows only has no id and keeps them. No row is dropped.
    """
    given = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("row"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    rows = staged(
        given.withColumn("set", described(F.col("text"), words)).select(
            "row",
            "text",
            F.col(f"row.`{id_column}`").alias("id"),
            F.monotonically_increasing_id().alias("number"),
            "set.*",
        ),
        "described",
    )
    by_id = F.struct(F.col("id").isNull().alias("unnamed"), "id", "number")
    same_set = rows.filter("size > 0").groupBy("print")
    classes = staged(same_set.agg(F.min("number").alias("node"), F.min(by_id).alias("first")), "classes")
    links = _links(rows, classes, words, percent)
    linked = connected(links)
    leaders = classes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = staged(leaders.groupBy("component").agg(F.min("first").alias("first")), "smallest")
    of_print = leaders.drop("first").join(smallest, "component").select("print", smallest["first"])
    found = rows.select("row", "id", "number", "print", F.col("size").alias("n_shingles"))
    empty = found.filter("n_shingles = 0").withColumn("first", by_id).drop("print")
    filled = found.filter("n_shingles > 0").join(of_print, "print").drop("print")
    return filled.unionByName(empty).select(
        "row",
        "n_shingles",
        F.col("first.id").alias("component_id"),
        F.col("id").eqNullSafe(F.col("first.id")).alias("kept"),
        (F.col("number") == F.col("first.number")).alias("first"),
    )


def _links(rows: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links ``a < b`` that hold the components of all candidate pairs together."""
    signed = rows.select("number", F.col("size").cast("int").alias("size"), "bits", "listed")
    nodes = staged(signed.join(classes.select(F.col("node").alias("number")), "number", "left_semi"), "nodes")
    listings = nodes.select(F.explode("listed").alias("key"), F.col("number").alias("node"), "size", "bits")
    # Most keys that two documents share by chance have no third; these two are looked at right here.
    shared = listings.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("bits").alias("differ"), F.min("size").alias("small"), F.max("size").alias("large")
    )
    two_may_link = (F.bit_count("differ") <= FAR_BITS) & (F.lit(100) * F.col("small") >= F.lit(percent) * F.col("large"))
    shared = shared.filter((F.col("n") > 2) | (F.col("n") == 2) & two_may_link).select("key", "n")
    met = listings.select("key", "node").join(shared, "key")
    facts = nodes.select(F.col("number").alias("node"), F.struct(F.col("number").alias("node"), "size", "bits").alias("member"))
    met = staged(met.join(facts, "node").select("key", "n", "member"), "met")
    # How many others a node meets: the original of a group meets more than its copies do.
    fame = met.groupBy(F.col("member.node").alias("node")).agg(F.sum("n").alias("fame"))
    famed = met.join(fame, met["member.node"] == fame["node"]).select("key", "member", "fame")
    hubs = famed.groupBy("key").agg(F.max_by("member", F.struct("fame", "member")).alias("hub"), F.min("member").alias("low"))
    met = staged(met.drop("n").join(hubs, "key"), "met-hubs")
    low, hub = (met.select(F.col("member").alias("x"), F.col(end).alias("y")) for end in ("low", "hub"))
    # Only texts of nodes that meet others move on from here.
    meeting = met.select(F.col("member.node").alias("number")).distinct()
    texts = staged(rows.select("number", "text").join(meeting, "number", "left_semi"), "texts")
    tried = _plausible(hub.unionByName(low), percent)
    star_links = staged(_confirmed(tried, texts, words, percent), "star-links")
    parts = connected(star_links)
    placed = (
        met.select("key", F.col("hub.node").alias("hub"), "member.*")
        .join(parts, "node", "left")
        .select("key", "hub", "node", "size", "bits", F.coalesce("component", "node").alias("part"))
    )
    open_keys = (
        placed.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("key")
    )
    # Nodes that meet under a key share its hub, and have few hubs, but many keys.
    still = staged(placed.join(open_keys, "key").select("hub", "node", "size", "bits", "part").distinct(), "open")
    apart = texts.join(still.select(F.col("node").alias("number")).distinct(), "number", "left_semi")
    sets = apart.select(F.col("number").alias("node"), _sets(words)("text").alias("set"))
    return star_links.unionByName(staged(_across(still, sets, percent), "more-links"))


def _across(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a < b`` between nodes that share a hub and lie in different components: enough of them to hold together whatever
    links connect.

    The nodes of a large hub are dealt to blocks of bounded size, and each two blocks are compared by
    themselves; many small hubs share a group.
    """
    weight = F.sum(F.col("size").cast("long") * 8)
    whole = rows.agg(F.count(F.lit(1)).alias("n"), weight.alias("bytes")).first()
    bundles = max(1, whole["n"] // BLOCK_ROWS, (whole["bytes"] or 0) // BLOCK_BYTES)
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(weight / BLOCK_BYTES)).cast("int")
    sizes = rows.groupBy("hub").agg(blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, "hub").withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    alone = F.when(F.col("blocks") > 1, F.col("hub"))
    blocked = dealt.select(
        F.coalesce(alone, F.pmod(F.xxhash64("hub"), F.lit(bundles))).alias("bundle"), alone.alias("alone"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "hub", "own", "node", "part", "size", "bits",
    ).join(sets, "node")

    def compare(table: pa.Table) -> pa.Table:
        hub, own = table["hub"].to_numpy(), table["own"].to_numpy()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        order = np.lexsort((own != i, hub))
        hub, own = hub[order], own[order]
        node, part, size, bits = (table[c].to_numpy()[order] for c in ("node", "part", "size", "bits"))
        shingles = [np.frombuffer(x, "<u8") for x in table["set"].take(pa.array(order)).to_pylist()]
        n = len(hub)
        # Each row meets the rows after it that have its hub, or the other block's.
        starts = np.arange(1, n + 1) if i == j else np.full(n, (own == i).sum())
        stops = np.searchsorted(hub, hub, side="right") if i == j else np.where(own == i, n, starts)
        a, b = joining_links(part, size.astype(np.int64), bits, shingles, starts, stops, percent)
        a, b = node[a], node[b]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return blocked.groupBy("bundle", "alone", "i", "j").applyInArrow(compare, "a long, b long")


def joining_links(part, size, bits, shingles: list[np.ndarray], starts, stops, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, each row ``x`` with rows from ``starts[x]`` to ``stops[x]``, that are linked and join two parts that
    no pair before has joined."""
    first = np.concatenate([[0], np.cumsum(size)])
    _, codes = np.unique(np.concatenate(shingles), return_inverse=True)
    marked = np.zeros(int(codes.max(initial=0)) + 1, bool)
    label = np.unique(part, return_inverse=True)[1]
    found_x, found_y = [], []
    for x in np.flatnonzero(stops > starts).tolist():
        y = np.arange(starts[x], stops[x])
        y = y[label[y] != label[x]]
        y = y[100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])]
        y = y[np.bitwise_count(bits[y] ^ bits[x]) <= FAR_IN_BLOCK]
        if not len(y):
            continue
        own = codes[first[x] : first[x + 1]]
        marked[own] = True
        until = np.cumsum(size[y])
        begin = 0
        while begin < len(y):
            end = max(begin + 1, int(np.searchsorted(until, until[begin] - size[y[begin]] + SHINGLES_AT_ONCE, side="right")))
            some = y[begin:end]
            begin = end
            some = some[label[some] != label[x]]
            if not len(some):
                continue
            both = marked[codes[ragged(first[some], size[some])]]
            both = np.add.reduceat(both, np.cumsum(size[some]) - size[some], dtype=np.int64)
            for z in some[100 * both >= percent * (size[some] + size[x] - both)].tolist():
                if label[z] != label[x]:
                    found_x.append(x)
                    found_y.append(z)
                    label[label == label[z]] = label[x]
        marked[own] = False
    return np.array(found_x, np.int64), np.array(found_y, np.int64)


def _may_link(x: str, y: str, percent: int) -> Column:
    near = F.bit_count(F.col(f"{x}.bits").bitwiseXOR(F.col(f"{y}.bits"))) <= FAR_BITS
    sizes = F.col(f"{x}.size"), F.col(f"{y}.size")
    return near & (100 * F.least(*sizes) >= percent * F.greatest(*sizes))


def _plausible(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct ``a < b`` of pairs whose lengths and one-bit signatures allow the similarity."""
    return (
        pairs.filter((F.col("x.node") != F.col("y.node")) & _may_link("x", "y", percent))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    left = texts.select(F.col("number").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("number").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(_similar(words, percent)("text_a", "text_b")).select("a", "b")
