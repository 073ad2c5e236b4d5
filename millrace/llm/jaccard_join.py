"""N-gram Jaccard join by parity sketches.

Documents are sets of word shingles. In each size band (shingle counts from one power of two to the
next) a set is written as a sketch of words: every shingle picks one word by its hash and XORs its
hash into it. A shingle that only one of two sets holds changes one word, so the number of differing
words (the sketches' Hamming distance) is at most the symmetric difference, which for linked sets is
at most a third of the smaller one. With more non-empty words than that, two linked sets agree in
one of them: pigeonhole. So non-empty words are the join keys, and pairs that share a key are
verified on their whole sets.

Bands from `2 * PER_BAND` shingles up sketch only the shingles whose hash lies under a rate fixed by
the band, about `PER_BAND` to `2 * PER_BAND` of them, as a linked pair there shares far more words
than one: the chance that none of its common shingles is under the rate is below
exp(-0.857 * PER_BAND), 1.3e-12 for a link, the same for any data. Verification always covers all
shingles. A set is sketched in its own band and, if a linked set may lie there, the one below.

A second sketch of `BITS` parity bits, one flipped per shingle, drops pairs before their texts are
fetched: its Hamming distance, too, is at most the symmetric difference, whatever the size.

Keys that many sets share (a licence line, a family of copies) never give all pairs. With all keys in one
order, the rarest first, two linked sets share one of the first ones of both, as many as a linked set
may lack and one more (in sampled bands by a tail bound that lets all changed shingles be the
set's own rare ones). So a set with enough rare keys needs no frequent one, and any other set only
as many of its frequent keys, the rarest of them, as it is short of. Sets with such a key are linked
to one pivot per key. What links are left lie between components and have a set outside a key's
largest component. Of the sets of keys that span components, all shingles are counted, those of one
component dropped, and the others put in one order, the rarest first: the rarest that two linked
sets share is among the first quarter (and one more) of both. If few sets hold it, they are listed
and verified. If not, all that the two share is frequent, so each has enough frequent shingles for
both sizes: sets are grouped by size and by the greatest size their frequent shingles allow a
partner, and only groups that allow each other are compared, in blocks and by parity bits first; a
set yields at most one link to each other component of a block. Pages that share a footer, too
short to link them, meet no other page.
"""

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

SHINGLE = 5
# Linked: 100 * intersection >= PERCENT * union.
PERCENT = 75
# Sketched shingles of the smallest set of a large band, and words of a sketch.
PER_BAND, WORDS = 32, 256
# A key of more sets is frequent: no list of all its sets is made.
FREQUENT = 32
# Chance that a set with enough keys that are not frequent shares none of them with a linked one.
LOST = 1e-12
# Parity bits of the second sketch.
BITS = 2048
# Sets, or characters of their texts, in a block of those that are compared directly, and classes
# of sizes from one power of two to the next.
BLOCK_SETS, BLOCK_CHARACTERS, CLASSES = 4096, 64_000_000, 8
# Words tokenised and hashed at a time, and rows handed back together.
BLOCK, ROWS = 50_000, 256
# Bits that mark the documents whose texts are needed: at most 2 ** 18 words of 64 in a broadcast.
MARK_BITS = 24

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP, _GOLD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64, on unsigned 64-bit arrays."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; texts are hashed in blocks of words."""
    held, size = [], 0
    for text in texts:
        words = words_of(text or "")
        held.append(words)
        size += len(words)
        if size >= BLOCK:
            yield from _hashed(held)
            held, size = [], 0
    yield from _hashed(held)


def _hashed(documents: list[list[bytes]]) -> Iterator[np.ndarray]:
    words = np.array([w for d in documents for w in d], dtype=object)
    if len(words):
        words = pd.util.hash_array(words, categorize=False)
    words = words.astype(np.uint64)
    rolled = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        rolled = (rolled + words[k : k + len(rolled)]) * _STEP
    rolled, start = _mix(rolled), 0
    for document in documents:
        n, end = len(document), start + len(document)
        if n >= SHINGLE:
            yield np.unique(rolled[start : end - SHINGLE + 1])
        elif n:
            value = np.full(1, n, np.uint64) * _GOLD
            for word in words[start:end]:
                value = (value + word) * _STEP
            yield _mix(value)
        else:
            yield rolled[:0]
        start = end


def signature(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers for a set, the node and its check: equal sets have equal ones."""
    totals = [_mix(hashes ^ _GOLD).sum(dtype=np.uint64), _mix(hashes + _STEP).sum(dtype=np.uint64)]
    node, check = _mix(np.array(totals) + np.uint64(len(hashes))).view(np.int64).tolist()
    return node, check


def bands(n: int) -> list[int]:
    """The set's own band, and the one below if a set of it may be linked to this one."""
    own = n.bit_length() - 1
    below = own > 0 and 100 * (2**own - 1) >= PERCENT * n
    return [own, own - 1] if below else [own]


def sampled(hashes: np.ndarray, band: int) -> np.ndarray:
    """The shingles that are sketched in a band."""
    if 2**band > PER_BAND:
        limit = np.uint64((PER_BAND << 64) // 2**band)
        hashes = hashes[: np.searchsorted(hashes, limit)]
    return hashes


@functools.lru_cache(maxsize=None)
def _bound(sketched: int, expected: int) -> int:
    """More keys than a linked set may lack of a set with so many sketched shingles, but for LOST.

    Of a set's shingles a linked set lacks a share of at most a quarter; with the share it lacks,
    its own further ones (`expected` would be all of the set) come to at most (1 - 4 share) / 3. A
    key changes by a lacking shingle or by a further one that picks its word.
    """
    low, high = 1, sketched + 1
    while low < high:
        need = (low + high) // 2
        if max(_tail(need, sketched, share / 40, expected) for share in range(11)) < LOST:
            high = need
        else:
            low = need + 1
    return low


def _tail(need: int, sketched: int, share: float, expected: int) -> float:
    """Chance that binomially many lacking and Poisson many further shingles change `need` keys."""
    log = math.lgamma
    k = range(sketched + 1) if share else range(1)
    odds = [math.log(share), math.log(1 - share)] if share else [0, 0]
    ways = [log(sketched + 1) - log(i + 1) - log(sketched - i + 1) if share else 0.0 for i in k]
    lacking = np.exp([w + i * odds[0] + (sketched - i) * odds[1] for i, w in zip(k, ways, strict=True)])
    mean = max(expected * (1 - 4 * share) / 3 * min(need / WORDS, 1), 1e-300)
    further = np.exp([i * math.log(mean) - mean - log(i + 1) for i in range(need + 100)])
    return float(np.convolve(lacking, further)[need:].sum())


def needed(n: int, sketched: int, band: int) -> int:
    """So many keys that are not frequent find every link of a set: the pigeonhole's bound and one
    more, or in sampled bands, where the difference is a matter of chance, its tail bound."""
    if 2**band <= PER_BAND:
        return n * (100 - PERCENT) // PERCENT + 1
    # The expected number in steps of PER_BAND, for few bounds to be computed.
    return _bound(sketched, PER_BAND * -(-n // 2**band))


def sketch_keys(hashes: np.ndarray, band: int) -> np.ndarray:
    """A key per non-empty word: a hash of band, place and content; its low 6 bits are the band."""
    hashes = sampled(hashes, band)
    if not len(hashes):
        return np.zeros(0, np.int64)
    # Small sets get so many words that two of their shingles hardly ever share one.
    place = _mix(hashes + _GOLD) >> np.uint64(32 if band < 4 else 65 - WORDS.bit_length())
    order = np.argsort(place, kind="stable")
    place, content = place[order], _mix(hashes[order] ^ _M2)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    words = np.bitwise_xor.reduceat(content, first)
    keys = _mix(words + _mix(place[first] + np.full(1, band, np.uint64) * _GOLD))
    return ((keys & ~np.uint64(63)) | np.uint64(band)).view(np.int64)


def parity_bits(hashes: np.ndarray) -> np.ndarray:
    """BITS bits as signed 64-bit numbers, each the parity of the shingles that picked it."""
    place = (_mix(hashes ^ _M1) >> np.uint64(40)) % np.uint64(BITS)
    odd = np.bincount(place.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


SKETCHES = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("node", pa.int64())]
    + [("check", pa.int64())]
    + [("keys", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())), ("needed", pa.list_(pa.int64()))]
)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A set met before in the task goes out without its keys."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            part = batch.slice(start, ROWS)
            out = {"n": [], "node": [], "check": [], "keys": [], "bits": [], "needed": []}
            for hashes in shingle_sets(part["text"].to_pylist()):
                n = len(hashes)
                name = signature(hashes) if n else (None, None)
                out["n"].append(n)
                out["node"].append(name[0])
                out["check"].append(name[1])
                new = n and name not in seen
                out["keys"].append(np.concatenate([sketch_keys(hashes, b) for b in bands(n)]) if new else None)
                out["bits"].append(parity_bits(hashes) if new else None)
                enough = [needed(n, len(sampled(hashes, b)), b) for b in bands(n)] if new else None
                out["needed"].append(enough)
                seen.add(name)
            arrays = [part["doc_id"], part["text_hash"], *out.values()]
            typed = zip(arrays, SKETCHES, strict=True)
            typed = [pa.array(a, f.type) if isinstance(a, list) else a for a, f in typed]
            yield pa.RecordBatch.from_arrays(typed, schema=SKETCHES)


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column)
    doc_id = F.col(id_column).cast("long").alias("doc_id")
    return docs.select(doc_id, F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _row() -> Column:
    return F.struct("doc_id", "text_hash")


def _pairs_within(lists: DataFrame) -> DataFrame:
    """Pairs (a < b) of members of short lists, each once."""

    def with_later(a: Column, place: Column) -> Column:
        later = F.slice("members", place + 2, FREQUENT)
        return F.transform(later, lambda b: F.struct(a.alias("a"), b.alias("b")))

    pairs = F.flatten(F.transform("members", with_later))
    return lists.select(F.explode_outer(pairs).alias("pair")).select("pair.a", "pair.b").distinct()


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose parity bits and sizes allow a link: nothing that is linked is dropped."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    differing = F.aggregate(
        F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    sized = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    close = (100 + PERCENT) * differing <= (100 - PERCENT) * (F.col("n_a") + F.col("n_b"))
    found = pairs.join(a, "a").join(b, "b").where(sized).where(close)
    return materialize(found.select("a", "b"), "near-pairs")


def _marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """`rows` and `marked`: true where doc_id and text_hash are in `wanted`, and at random for others.

    Others are marked with a chance of at most the number of wanted ones over 2 ** MARK_BITS. A join
    with those marked is the join with all rows, but does not shuffle and sort the texts of the rest.
    """
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash"), 64 - MARK_BITS)
    word, bit = F.shiftright(place, 6).alias("word"), place.bitwiseAND(63).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = wanted.groupBy(word).agg(F.bit_or(one).alias("marks"))
    found = rows.withColumn("word", word).join(F.broadcast(words), "word", "left")
    marked = F.coalesce(F.getbit("marks", bit) == 1, F.lit(False))
    return found.withColumn("marked", marked).drop("word", "marks")


def _texts(named: DataFrame, nodes: DataFrame, involved: DataFrame) -> DataFrame:
    """(node, text): for each involved set the text of its first document."""
    rows = nodes.join(involved.distinct(), "node").select("node", "row.doc_id", "row.text_hash")
    rows = materialize(rows, "set-rows")
    same = F.col("r.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("r.text_hash") == F.col("t.text_hash"))
    marked = _marked(named, rows).where("marked")
    found = rows.alias("r").join(marked.alias("t"), same).groupBy("node").agg(F.first("text").alias("text"))
    return materialize(found, "set-texts")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by their whole sets."""
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    tested = both.select("a", "b", "text_a", "text_b").mapInArrow(_tested, "a long, b long, linked boolean")
    return materialize(tested.where("linked").select("a", "b"), "links")


def _are_linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            part, linked, last, set_a = batch.slice(start, ROWS), [], None, None
            for a, text_a, text_b in zip(*(part[c].to_pylist() for c in ("a", "text_a", "text_b")), strict=True):
                if set_a is None or a != last:
                    last, set_a = a, next(shingle_sets([text_a]))
                linked.append(_are_linked(set_a, next(shingle_sets([text_b]))))
            arrays = [part["a"], part["b"], pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "linked"])


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable), for nodes with a link.

    Alternates large-star and small-star steps; each step is stored, so no plan or recomputation
    grows, and neighbours are only ever combined to a minimum.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        larger = both.join(least, "u").where(F.col("v") > F.col("u"))
        large = larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        others = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(others.union(lowest.select("u", "m")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.toDF("node", "component").union(edges.select("v", "v").distinct())


def _compared(ones: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """For each set of one block a link to each other component of the other block, if there is one."""
    found = []
    if len(ones) and len(others):
        sets, bits = list(shingle_sets(others["text"].tolist())), np.stack(others["bits"].tolist()).view(np.uint64)
        sizes, reaches, nodes, labels = (others[c].to_numpy() for c in ("n", "reach", "node", "component"))
        each = (ones[c] for c in ("node", "component", "n", "reach", "bits"))
        for node, label, n, reach, row, one in zip(*each, shingle_sets(ones["text"].tolist()), strict=True):
            at = np.flatnonzero((labels != label) & (sizes <= reach) & (reaches >= n))
            differing = np.bitwise_count(bits[at] ^ np.asarray(row).view(np.uint64)).sum(axis=1, dtype=np.int64)
            close = (100 + PERCENT) * differing <= (100 - PERCENT) * (sizes[at] + n)
            done = set()
            for i in at[close][np.argsort(differing[close], kind="stable")]:
                if labels[i] not in done and _are_linked(one, sets[i]):
                    done.add(labels[i])
                    found.append((min(node, nodes[i]), max(node, nodes[i])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each set, handed on when there are BLOCK of them."""
    names = ["node", "component", "outside"]
    for batch in batches:
        held, start, size = [], 0, 0
        for hashes in shingle_sets(batch["text"].to_pylist()):
            held.append(hashes.view(np.int64))
            size += len(hashes)
            if size >= BLOCK or start + len(held) == len(batch):
                columns = [batch[c].slice(start, len(held)) for c in names]
                columns.append(pa.array(held, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [*names, "shingles"])
                held, start, size = [], start + len(held), 0


def _shared_shingles(sets: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """For each set the shingles that sets of other components hold too: how many of those are
    frequent, and the others that may be the rarest it shares with a linked set.

    Sets without enough shared shingles for a link are left out.
    """
    ones = sets.groupBy("node").agg(F.first("component").alias("component"), F.bool_or("outside").alias("outside"))
    schema = "node long, component long, outside boolean, shingles array<long>"
    whole = ones.join(texts, "node").mapInArrow(_shingled, schema)
    each = whole.select("node", "component", "outside", F.explode_outer("shingles").alias("shingle"))
    several = F.min("component") != F.max("component")
    held = each.groupBy("shingle").agg(F.count("*").alias("sets"), several.alias("several"))
    held = materialize(held.where("several").select("shingle", "sets"), "held-shingles")
    rare = F.when(F.col("sets") <= FREQUENT, F.struct("sets", "shingle"))
    counted = each.join(held, "shingle").groupBy("node", "component", "outside").agg(
        F.count("*").alias("shared"),
        F.count_if(F.col("sets") > FREQUENT).alias("frequent"),
        F.sort_array(F.collect_list(rare)).alias("rare"),
    )
    # Places among the first shingles of the order that those of one component do not take.
    places = F.floor(F.col("n") * (100 - PERCENT) / 100) + 1 - (F.col("n") - F.col("shared"))
    counted = counted.join(nodes.select("node", "n"), "node").withColumn("places", places.cast("int"))
    first = F.slice("rare", 1, F.col("places"))["shingle"].alias("rare")
    kept = counted.where("places > 0").select("node", "component", "outside", "n", "frequent", first)
    return materialize(kept, "shared-shingles")


def _rare_pairs(shared: DataFrame) -> DataFrame:
    """Pairs of sets of different components that have one of their first rare shingles in common."""
    member = F.struct("node", "component", "outside")
    members = shared.select(member.alias("member"), F.explode("rare").alias("shingle"))
    # At most FREQUENT members in a list.
    lists = members.groupBy("shingle").agg(F.array_sort(F.collect_list("member")).alias("members"))
    pairs = _pairs_within(lists.where(F.size("members") > 1).select("members").distinct())
    pairs = pairs.where("a.component <> b.component AND (a.outside OR b.outside)")
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def _meetings(groups: list) -> list[tuple[int, int, int, int, int]]:
    """Band, group, its blocks of sets outside, group, its blocks: the groups that allow each other."""

    def blocks(sets, characters):
        return max(-(-sets // BLOCK_SETS), -(-characters // BLOCK_CHARACTERS), 1)

    by_band: dict[int, list] = {}
    for group in groups:
        by_band.setdefault(group["band"], []).append(group)
    return [
        (band, a["group"], blocks(a["outside"], a["outside_characters"]), b["group"], blocks(b["all"], b["characters"]))
        for band, members in by_band.items()
        for a in members
        for b in members
        if a["outside"] and a["least"] <= b["reach"] and b["least"] <= a["reach"]
    ]


def _reach() -> Column:
    """The greatest size that a set's frequent shingles allow a linked one, if all they share is frequent."""
    return F.floor(F.col("frequent") * (100 + PERCENT) / PERCENT) - F.col("n")


def _met(rows: DataFrame, meetings: DataFrame, own: str, other: str) -> DataFrame:
    """Each set in its block, once for each block that its group's meet."""
    named = meetings.withColumn("group", F.col(f"{own}_group"))
    placed = rows.join(F.broadcast(named), ["band", "group"])
    block = F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
    placed = placed.withColumn(own, block).withColumn(other, each)
    groups = ["band", "one_group", "other_group", "one", "other"]
    kept = placed.select(*groups, "node", "component", "n", "reach", "bits", "text")
    # Columns of their own, since the two sides of a cogroup come from the same sets.
    return kept.toDF(*kept.columns)


def _frequent_links(sets: DataFrame, shared: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links of sets that may have nothing but frequent shingles in common."""
    able = shared.select("node", "n", _reach().alias("reach"))
    able = able.where(100 * F.col("reach") >= PERCENT * F.col("n"))
    rows = sets.join(able, "node").join(nodes.select("node", "bits"), "node").join(texts, "node")
    step = F.greatest(F.lit(1), F.floor(F.pow(F.lit(2), F.col("band")) / CLASSES)).cast("long")
    classes = [F.floor(F.col(c) / step).cast("int") for c in ("n", "reach")]
    # Sizes in a band go up to 8 / 3 of its least, reaches to 4 / 3 of a size.
    rows = materialize(rows.withColumn("group", classes[0] * 64 * CLASSES + classes[1]), "compared-sets")
    # Some 25 classes of sizes and 30 of reaches in each of at most 64 bands.
    characters = F.length("text")
    groups = rows.groupBy("band", "group").agg(
        F.count("*").alias("all"),
        F.count_if("outside").alias("outside"),
        F.sum(characters).alias("characters"),
        F.sum(F.when(F.col("outside"), characters).otherwise(0)).alias("outside_characters"),
        F.min("n").alias("least"),
        F.max("reach").alias("reach"),
    )
    meetings = _meetings(groups.collect())
    if not meetings:
        return None
    schema = "band int, one_group int, one_blocks int, other_group int, other_blocks int"
    meetings = rows.sparkSession.createDataFrame(meetings, schema)
    keys = ["band", "one_group", "other_group", "one", "other"]
    ones = _met(rows.where("outside"), meetings, "one", "other").groupBy(*keys)
    others = _met(rows, meetings, "other", "one").groupBy(*keys)
    found = ones.cogroup(others).applyInPandas(_compared, "a long, b long")
    return materialize(found.distinct(), "links")


def _common_links(shared: DataFrame, nodes: DataFrame, texts: DataFrame, links: DataFrame) -> DataFrame:
    """Links among sets that share frequent keys (`shared`: key, band, node), added to `links`."""
    # What is aggregated by a key is stored before it is joined, so that AQE can split a hot key.
    pivots = materialize(shared.groupBy("key").agg(F.min("node").alias("a")), "pivots")
    pairs = shared.join(pivots, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    links = links.union(_linked(_near(pairs, nodes), texts))

    labelled = shared.join(components(links), "node", "left")
    labelled = materialize(labelled.withColumn("component", F.coalesce("component", "node")), "labelled-keys")
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("kinds")
    )
    mixed = labelled.join(materialize(main.where("kinds > 1").drop("kinds"), "mixed-keys"), "key")
    outside = F.bool_or(F.col("component") != F.col("main")).alias("outside")
    sets = materialize(mixed.groupBy("node", "band", "component").agg(outside), "outside-sets")
    if sets.isEmpty():
        return links
    held = _shared_shingles(sets, nodes, texts)
    links = links.union(_linked(_near(_rare_pairs(held), nodes), texts))
    further = _frequent_links(sets, held, nodes, texts)
    return links if further is None else links.union(further)


def _sets(sketches: DataFrame) -> DataFrame:
    return sketches.where("node IS NOT NULL").groupBy("node").agg(
        F.max("n").alias("n"),
        F.min(_row()).alias("row"),
        F.first("keys", ignorenulls=True).alias("keys"),
        F.first("bits", ignorenulls=True).alias("bits"),
        F.first("needed", ignorenulls=True).alias("needed"),
        F.min("check").alias("least"),
        F.max("check").alias("greatest"),
    )


def _distinct_sets(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketches, and one row per set. Where sets share a node, all but that of the least check are renamed."""
    nodes = materialize(_sets(sketches), "sets")
    clashing = nodes.where("least <> greatest").select("node", "least")
    # One yes or no: billions of sets share a node a few times, if at all.
    if not clashing.isEmpty():
        own = F.col("least").isNull() | (F.col("least") == F.col("check"))
        renamed = F.when(own, F.col("node")).otherwise(F.xxhash64("node", "check"))
        sketches = sketches.join(clashing, "node", "left").withColumn("node", renamed).drop("least")
        sketches = materialize(sketches, "sketches")
        nodes = materialize(_sets(sketches), "sets")
    return sketches, nodes.drop("least", "greatest")


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text_hash, n and the component of each document, null for one without shingles."""
    named = _named(docs, id_column, text_column)
    schema = "doc_id long, text_hash long, n long, node long, check long"
    schema += ", keys array<long>, bits array<long>, needed array<long>"
    sketches, nodes = _distinct_sets(materialize(named.mapInArrow(_sketched, schema), "sketches"))
    keyed = nodes.select("node", F.explode_outer("keys").alias("key"))
    counted = keyed.groupBy("key").agg(F.count("*").alias("sets"))
    shared = materialize(counted.where("sets > 1"), "shared-keys")
    # Most keys are of one set. Those shared are stored with their sets, so that all keys move once more, not twice.
    members = materialize(keyed.join(shared, "key"), "shared-members")

    # At most FREQUENT members in a list.
    listed = F.array_sort(F.collect_list("node")).alias("members")
    lists = members.where(F.col("sets") <= FREQUENT).groupBy("key").agg(listed)
    pairs = _near(_pairs_within(lists.select("members").distinct()), nodes)

    frequent = members.where(F.col("sets") > FREQUENT)
    frequent = frequent.withColumn("band", F.col("key").bitwiseAND(63))
    # The rarest first, in an order all sets share; no more than a sketch has words.
    rarest = F.sort_array(F.collect_list(F.struct("sets", "key"))).alias("hot")
    hot = frequent.groupBy("node", "band").agg(rarest)
    # The set's own band comes first, the one below second. Keys are counted before the join: numbers are shuffled.
    own = F.length(F.bin("n")) - 1
    in_own = F.size(F.filter("keys", lambda k: k.bitwiseAND(63) == own)).alias("in_own")
    held = nodes.select("node", "needed", own.alias("own"), in_own, F.size("keys").alias("in_all"))
    enough = F.element_at("needed", (F.col("own") - F.col("band") + 1).cast("int")).cast("int")
    in_band = F.when(F.col("band") == F.col("own"), F.col("in_own")).otherwise(F.col("in_all") - F.col("in_own"))
    others = in_band - F.size("hot")
    lacking = held.join(hot, "node").select("node", "band", "hot", (enough - others).alias("lacking"))
    used = F.slice("hot", 1, F.col("lacking"))["key"]
    common = lacking.where("lacking > 0").select("node", "band", F.explode(used).alias("key"))
    common = materialize(common.select("key", "band", "node"), "common")

    involved = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(common.select("node"))
    texts = _texts(named, nodes, involved)
    links = _linked(pairs, texts)
    if not common.isEmpty():
        links = _common_links(common, nodes, texts, links)
    out = sketches.select("doc_id", "text_hash", "n", "node").join(components(links), "node", "left")
    return materialize(out.withColumn("component", F.coalesce("component", "node")), "components")


def join_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id, one row per input row.

    Shingles are of `SHINGLE` words; a text of fewer words is one shingle of all its words. A null
    text, or one without words, has none and is linked with nothing: its component is its own id.
    Documents of equal sets share a component. component_id is the smallest id reachable by links;
    null ids are passed over unless there is no other. Repeated rows and ids are separate
    documents. An empty table gives an empty result. Other columns are not read.
    """
    grouped = _grouped(docs, id_column, text_column)
    smallest = grouped.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    named = grouped.join(smallest, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with one document of each component: the smallest id, a null id last, then by text hash.

    Columns pass through as they are. Rows that share id and text are one document and stay or go
    together; texts without words all stay.
    """
    grouped = _grouped(docs, id_column, text_column).where("component IS NOT NULL")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = grouped.groupBy("component").agg(F.min(place).alias("first"))
    gone = grouped.join(first, "component").where(~place.eqNullSafe(F.col("first")))
    gone = materialize(gone.select("doc_id", "text_hash").distinct(), "gone")
    id_value, text_hash = F.col(id_column).cast("long"), F.xxhash64(F.col(text_column))
    rows = docs.select(F.struct("*").alias("document"), id_value.alias("doc_id"), text_hash.alias("text_hash"))
    rows = _marked(rows, gone)
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_hash") == F.col("g.text_hash"))
    kept = rows.where("marked").alias("d").join(gone.alias("g"), same, "left_anti")
    return kept.select("document.*").union(rows.where("NOT marked").select("document.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return join_near(spark.read.parquet(f"{sf_dir}/documents.parquet"))
