"""Exact Jaccard self-join on word n-grams by vertical partitioning, and the classes that its links make.

The global order of n-grams goes by how many documents have them, in powers of two, and by hash within; n-grams that only one
document has come before all others.

1. Buffers of documents send their n-grams, packed, to fragments of the hash range, which count the documents of each; an
   n-gram that a buffer has several times is sent once, with its count. Fragments answer to each buffer which of its n-grams
   are shared, and their place in the global order. A set whose shared n-grams are too few to reach the threshold leaves
   here; most do.
2. Of each remaining set only a prefix in the global order, its rarest shared n-grams, needs to meet others: two linked sets
   have a common n-gram among their first c - need + 1 shared ones. Lists of sets that meet never make their pairs. First
   each set is compared with one leader, the set of its lists with the fewest n-grams of its own. Lists within one component
   are then settled. In the others, sets with one leader, as in a large group of near copies, meet by what each has beside
   it or lacks of it, all at once, in blocks of bounded size: two such sets that are not both linked to the leader can only be
   linked if these differences share n-grams, which an index of them finds and counts exactly. Then pairs across leaders
   are left, of which one set is outside its list's largest component.
3. A comparison of a pair cuts the global order into PARTS fragments, counts common n-grams in each apart, and sums the
   partial counts per pair.

Length bounds hold before any comparison: the intersection is at most the smaller count of shared n-grams. Sets with the
same n-grams are one node from the start. Nothing is capped or sampled; components are exact, but that n-grams and sets are
told apart by hashes, of 58 and 64 bits.

Rows with null text or without words have an empty set, are linked with nothing, and are components of their own. Rows
that repeat a doc_id are separate documents; a null doc_id counts as larger than any other, so a component has a null id
only if all its ids are null. Other columns pass unchanged, whatever their names; those named like results are replaced."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.llm._graph import components
from tracklore.llm._hash import Words, mix, prefix, span, windows
from tracklore.llm._work import Work, aside, bounded, bounded_batches, groups_of, held, restored, text_bytes, texts_of

#: Bytes of text for each fragment of the hash range; bounds what one task sorts.
FRAGMENT = 16_000_000
#: Bytes of text packed together before the exchange.
BUFFER = 2_000_000
PARTS = 4
#: Differences from a leader in one block of its sets.
BLOCK = 2_000_000
_LOW = np.uint64(2**48 - 1)
_32 = np.uint64(32)
#: Keys stand for n-grams after the exchange: the place in the global order in the upper bits, 58 bits of hash below.
_HASH = np.uint64(2**58 - 1)


def _sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all texts end to end, how many each has, and an id of each set (0: empty)."""
    words = Words(texts, lower=True)
    grams = windows(words.hash, n)
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    lone = dict(zip(short.tolist(), span(prefix(words.hash), words.first[short], words.first[short] + words.count[short]), strict=True)) if len(short) else {}
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i, (a, k) in enumerate(zip(words.first.tolist(), words.count.tolist())):
        if k >= n:
            own = np.unique(grams[a : a + k - n + 1])
        elif k:
            own = np.array([lone[i]], np.uint64)
        else:
            continue
        out.append(own)
        sizes[i] = len(own)
    flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
    cut = np.append(0, np.cumsum(sizes))
    total = np.append(np.uint64(0), np.cumsum(mix(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5))))
    ids = mix(total[cut[1:]] - total[cut[:-1]] + sizes.astype(np.uint64))
    return flat, sizes, np.where(sizes > 0, ids, 0).astype(np.uint64)


def _fragment(grams: np.ndarray, count: int) -> np.ndarray:
    return (((grams >> _32) * np.uint64(count)) >> _32).astype(np.int64)


def _hash58(fragment: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix((fragment.astype(np.uint64) << np.uint64(48)) ^ low) & _HASH


def _pack48(x: np.ndarray) -> bytes:
    return x.astype(np.uint32).tobytes() + (x >> _32).astype(np.uint16).tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    n = len(data) // 6
    return np.frombuffer(data, np.uint32, n).astype(np.uint64) | (np.frombuffer(data, np.uint16, n, 4 * n).astype(np.uint64) << _32)


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before, and their number."""
    n = len(columns[0])
    change = np.ones(n, bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(change), n)


def with_sets(docs: DataFrame, n: int, text: str) -> DataFrame:
    """docs, without the text, with _set (0: empty) and _n (distinct n-grams)."""
    kept = [c for c in docs.columns if c != text]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("_set", T.LongType()), T.StructField("_n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("sets", object)
        for batch in batches:
            texts = texts_of(batch.column(len(kept)))
            for start, stop in groups_of(texts, BUFFER):
                _, sizes, ids = _sets(texts[start:stop], n)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(kept))), pa.array(ids.view(np.int64)), pa.array(sizes)], schema.names)

    return bounded(docs.select(*kept, text), run, schema)


#: ASKED: n-grams of a buffer in one fragment; with `who`, the document in the buffer of n-grams of one document, or with
#: `many`, the counts of n-grams of several. KEPT: those several documents by n-gram, and ids and sizes of the buffer's sets.
_ASKED, _KEPT = 0, 1
_PACKED = "fragment int, kind byte, buffer long, one binary, who binary, several binary, many binary"
_PACKED_TYPES = [pa.int32(), pa.int8(), pa.int64(), *[pa.binary()] * 4]


def _pack(texts: list[bytes], n: int, fragments: int) -> Iterator[tuple]:
    """Rows of _PACKED for one buffer; of equal sets the first counts."""
    flat, sizes, ids = _sets(texts, n)
    owner = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
    _, first = np.unique(ids, return_index=True)
    here = np.zeros(len(ids), bool)
    here[first] = True
    use = here[owner]
    flat, owner = flat[use], owner[use]
    if not len(flat):
        return
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    edge = _edges(flat)
    many = np.diff(edge)
    grams, frag, lead = flat[edge[:-1]], _fragment(flat[edge[:-1]], fragments), owner[edge[:-1]]
    single = many == 1
    # The buffer's number stands for its sets in their order: buffers of one number have the same questions and answers.
    places = np.arange(len(ids), dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D)
    buffer = int(mix(np.array([np.add.reduce(mix(np.where(here, ids, 0) ^ mix(places))) + np.uint64(len(ids))], np.uint64)).view(np.int64)[0])
    cut = np.searchsorted(frag, np.arange(fragments + 1)) if fragments < len(frag) else np.append(_edges(frag)[:-1], len(frag))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if a < b:
            one, several = a + np.flatnonzero(single[a:b]), a + np.flatnonzero(~single[a:b])
            # By document, whose numbers then shrink in the shuffle.
            one = one[np.argsort(lead[one], kind="stable")]
            yield int(frag[a]), _ASKED, buffer, _pack48(grams[one] & _LOW), lead[one].astype(np.uint16).tobytes(), _pack48(grams[several] & _LOW), many[several].astype(np.uint16).tobytes()
    several = ~single
    keys = _hash58(frag[several], grams[several] & _LOW)
    by_key = np.argsort(keys)
    spans = [owner[a:b] for a, b in zip(edge[:-1][several][by_key].tolist(), edge[1:][several][by_key].tolist())]
    who = np.concatenate(spans).astype(np.uint16) if spans else np.zeros(0, np.uint16)
    spot = int(_fragment(np.array([buffer], np.int64).view(np.uint64), fragments)[0])
    yield spot, _KEPT, buffer, np.concatenate([np.where(here, ids, 0), sizes.astype(np.uint64)]).tobytes(), who.tobytes(), keys[by_key].tobytes(), many[several][by_key].astype(np.uint16).tobytes()


_SHARED = T.StructType([T.StructField("set_id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("keys", T.ArrayType(T.LongType()))])
#: Answers of one fragment to the buffers of a bucket end to end: how many each has, documents and keys of n-grams of one
#: document, and keys of n-grams of several. A row with `sets` passes on what a buffer keeps.
_ANSWERS = "bucket int, buffers binary, ones binary, who binary, keys binary, severals binary, several binary, sets binary, counts binary"
_ANSWER_NAMES = [x.split()[0] for x in _ANSWERS.split(", ")]


def _answered(table: pa.Table, buckets: int) -> pa.Table:
    """Of one fragment: which n-grams two documents or more have, for each buffer that asked."""
    fragment, kinds = table.column("fragment")[0].as_py(), np.array(table.column("kind").to_pylist())
    buffers = table.column("buffer").to_numpy()
    one, who, several, many = (table.column(c).to_pylist() for c in ("one", "who", "several", "many"))
    asked = np.flatnonzero(kinds == _ASKED).tolist()
    lists = [_unpack48(one[i]) for i in asked] + [_unpack48(several[i]) for i in asked]
    sizes = [len(x) for x in lists]
    grams = np.concatenate([np.zeros(0, np.uint64), *lists])
    del lists
    ones = sum(sizes[: len(asked)])
    source = np.repeat(np.tile(np.arange(len(asked), dtype=np.int32), 2), sizes)
    # What is known of an n-gram: its document, or how many documents it has in the buffer.
    value = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(x[i], np.uint16) for x in (who, many) for i in asked)])
    order = np.argsort(grams)
    edge = _edges(grams[order])
    total = np.add.reduceat(np.where(order < ones, 1, value[order]).astype(np.int64), edge[:-1]) if len(grams) else np.zeros(0, np.int64)
    rarity = np.minimum(np.frexp(total.astype(np.float64))[1], 31).astype(np.uint64)
    keys = _hash58(np.full(len(total), fragment), grams[order[edge[:-1]]]) | (rarity << np.uint64(58))
    shared = np.repeat(total > 1, np.diff(edge))
    at, keys = order[shared], np.repeat(keys, np.diff(edge))[shared]
    del grams, order
    numbers = buffers[asked].view(np.uint64)
    bucket = _fragment(numbers, buckets)
    rank = np.empty(len(asked), np.int64)
    rank[np.lexsort((numbers, bucket))] = np.arange(len(asked))
    turn = np.lexsort((at >= ones, rank[source[at]]))
    at, keys = at[turn], keys[turn]
    part, alone = source[at], at < ones
    rows: list[dict] = []
    places = np.argsort(rank)
    begin = np.searchsorted(rank[part], np.arange(len(asked) + 1))
    count_one = np.add.reduceat(np.append(alone, False).astype(np.int64), begin[:-1]) * (np.diff(begin) > 0) if len(asked) else np.zeros(0, np.int64)
    count_several = np.diff(begin) - count_one
    edge = _edges(bucket[places]).tolist()
    for a, b in zip(edge, edge[1:]):
        some = slice(begin[a], begin[b])
        if begin[a] == begin[b]:
            continue
        lone = alone[some]
        rows.append({"bucket": int(bucket[places[a]]), "buffers": numbers[places[a:b]].tobytes(), "ones": count_one[a:b].astype(np.uint32).tobytes(), "who": value[at[some][lone]].tobytes(), "keys": keys[some][lone].tobytes(), "severals": count_several[a:b].astype(np.uint32).tobytes(), "several": keys[some][~lone].tobytes(), "sets": None, "counts": None})
    for i in np.flatnonzero(kinds == _KEPT).tolist():
        number = buffers[i : i + 1].view(np.uint64)
        rows.append({"bucket": int(_fragment(number, buckets)[0]), "buffers": number.tobytes(), "ones": None, "who": who[i], "keys": None, "severals": None, "several": several[i], "sets": one[i], "counts": many[i]})
    return pa.table([pa.array([r[c] for r in rows], pa.int32() if c == "bucket" else pa.binary()) for c in _ANSWER_NAMES], _ANSWER_NAMES)


def _gathered(table: pa.Table, percent: int) -> pa.Table:
    """Of one bucket of buffers: the sets that share enough n-grams to be linked with any, with these in the global order."""
    rows = table.to_pylist()
    alone: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    several: dict[int, list[np.ndarray]] = {}
    for r in rows:
        if r["sets"] is not None:
            continue
        who, keys, more = np.frombuffer(r["who"], np.uint16), np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["several"], np.uint64)
        ones, severals = (np.append(0, np.cumsum(np.frombuffer(r[c], np.uint32), dtype=np.int64)) for c in ("ones", "severals"))
        for k, number in enumerate(np.frombuffer(r["buffers"], np.uint64).tolist()):
            alone.setdefault(number, []).append((who[ones[k] : ones[k + 1]], keys[ones[k] : ones[k + 1]]))
            several.setdefault(number, []).append(more[severals[k] : severals[k + 1]])
    out_ids, out_sizes, out_counts, out_keys = [], [], [], []
    done = set()
    for r in rows:
        number = int(np.frombuffer(r["buffers"], np.uint64)[0])
        if r["sets"] is None or number in done:
            continue
        done.add(number)  # buffers of the same sets have one number, and the same answers
        ids, sizes = np.frombuffer(r["sets"], np.uint64).reshape(2, -1)
        own, keys = (np.concatenate([np.zeros(0, t), *x]) for t, x in zip((np.uint16, np.uint64), zip(*alone.get(number, [(np.zeros(0, np.uint16), np.zeros(0, np.uint64))]))))
        known, answer = np.frombuffer(r["several"], np.uint64), np.concatenate([np.zeros(0, np.uint64), *several.get(number, [])])
        if len(known):
            answer = np.unique(answer)
            answer = answer[np.argsort(answer & _HASH)]
            many = np.frombuffer(r["counts"], np.uint16)
            own = np.concatenate([own, np.frombuffer(r["who"], np.uint16)])
            keys = np.concatenate([keys, np.repeat(answer, many)])
        order = np.lexsort((keys, own))
        own, keys = own[order], keys[order]
        fresh = np.ones(len(own), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (keys[1:] != keys[:-1])
        own, keys = own[fresh], keys[fresh]
        edge = _edges(own)
        doc, count = own[edge[:-1]], np.diff(edge)
        enough = 100 * count >= percent * sizes[doc].astype(np.int64)
        out_ids.append(ids[doc][enough])
        out_sizes.append(sizes[doc][enough])
        out_counts.append(count[enough])
        out_keys.append(keys[np.repeat(enough, count)])
    ids, sizes, keys = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in (out_ids, out_sizes, out_keys))
    counts = np.concatenate([np.zeros(0, np.int64), *out_counts])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(keys.view(np.int64), pa.int64()))
    return pa.table([pa.array(ids.view(np.int64)), pa.array(sizes.astype(np.int32)), lists], _SHARED.names)


def shared_ngrams(docs: DataFrame, n: int, percent: int, fragments: int, text: str) -> DataFrame:
    """set_id, n (distinct n-grams), keys: the n-grams that other documents have too, in the global order, of each set that may
    have links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("sets", object)
        for batch in batches:
            texts = texts_of(batch.column(0))
            for start, stop in groups_of(texts, BUFFER):
                rows = list(_pack(texts[start:stop], n, fragments))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _PACKED_TYPES, strict=True)], [x.split()[0] for x in _PACKED.split(", ")])

    found = bounded(docs.select(text), run, _PACKED).groupBy("fragment").applyInArrow(lambda t: _answered(t, fragments), _ANSWERS)
    return found.groupBy("bucket").applyInArrow(lambda t: _gathered(t, percent), _SHARED).dropDuplicates(["set_id"])


def _enough(a: str, b: str, percent: int):
    """Whether two sets may be linked, by their sizes and counts of shared n-grams."""
    return (100 + percent) * F.least(F.col(f"{a}c"), F.col(f"{b}c")) >= percent * (F.col(f"{a}n") + F.col(f"{b}n"))


def _reaches(percent: int, common: str = "common"):
    return (100 + percent) * F.col(common) >= percent * (F.col("an") + F.col("bn"))


def _parts(eligible: DataFrame, cuts: list[int], key: str, keys: str) -> DataFrame:
    """The n-grams of each set by fragment of the global order."""
    bounds = F.array(*(F.struct(F.lit(i).alias("part"), F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")) for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, 2**63 - 1]))))
    split = F.transform(bounds, lambda x: F.struct(x.part.alias("part"), F.filter("keys", lambda k: (k >= x.low) & (k < x.high)).alias(keys)))
    return eligible.select(F.col("set_id").alias(key), F.explode(split).alias("x")).select(key, "x.part", f"x.{keys}")


def _compared(pairs: DataFrame, eligible: DataFrame, cuts: list[int], differences: bool) -> DataFrame:
    """pairs (a, b, an, bn) with common, the overlap, summed over fragments of the global order, and where wanted `apart`: what
    one of the two has alone, b's first."""
    left = pairs.join(_parts(eligible, cuts, "a", "left"), "a")
    both = left.join(_parts(eligible, cuts, "b", "right"), ["b", "part"])
    apart = [F.array_except("right", "left").alias("less"), F.array_except("left", "right").alias("more")] if differences else []
    partial = both.select("a", "b", "an", "bn", F.size(F.array_intersect("left", "right")).alias("common"), *apart)
    gathered = [F.flatten(F.collect_list("less")).alias("less"), F.flatten(F.collect_list("more")).alias("more")] if differences else []
    return partial.groupBy("a", "b", "an", "bn").agg(F.sum("common").cast("int").alias("common"), *gathered)


_LINKS = "a long, b long"


def _around(table: pa.Table, percent: int) -> pa.Table:
    """Of sets with one leader, of one block or of two: links that join their components, found by the differences from the
    leader that two sets share. Two sets of one component, or both linked to the leader, need no comparison."""
    rows = table.to_pydict()
    first, second = rows["i"][0], rows["j"][0]
    ids, n, comp, out, block = (np.array(rows[c]) for c in ("set_id", "n", "comp", "outside", "block"))
    size = rows["size"][0]
    less, more = np.array([len(x) for x in rows["less"]]), np.array([len(x) for x in rows["more"]])
    # `less` are n-grams of the leader and `more` are none, so the two never meet.
    flat = np.concatenate([np.array(x + y, np.int64) for x, y in zip(rows["less"], rows["more"])])
    owner = np.repeat(np.arange(len(ids)), less + more)
    order = np.argsort(flat, kind="stable")
    edge = _edges(flat[order])
    name = np.empty(len(flat), np.int64)
    name[order] = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    lists = owner[order]
    begin = np.append(0, np.cumsum(less + more))
    _, group = np.unique(comp, return_inverse=True)
    parent = np.arange(group.max() + 1)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    links = [[], []]
    for u in np.flatnonzero(out).tolist():
        mine = name[begin[u] : begin[u + 1]]
        if not len(mine) or (first != second and block[u] not in (first, second)):
            continue
        many = edge[mine + 1] - edge[mine]
        stop = np.cumsum(many)
        met = np.bincount(lists[np.arange(stop[-1]) + np.repeat(edge[mine] - (stop - many), many)], minlength=len(ids))
        common = size - less[u] - less + met
        good = (met > 0) & ((100 + percent) * common >= percent * (n[u] + n)) & (group != group[u])
        if first != second:
            good &= block != block[u]
        for v in np.flatnonzero(good).tolist():
            x, y = root(int(group[u])), root(int(group[v]))
            if x != y:
                parent[x] = y
                links[0].append(int(ids[u]))
                links[1].append(int(ids[v]))
    return pa.table({"a": pa.array(links[0], pa.int64()), "b": pa.array(links[1], pa.int64())})


def _by_leader(work: Work, members: DataFrame, percent: int) -> DataFrame:
    """Links among sets with one leader. members: set_id, n, comp, outside (not linked to it), leader, size (of its shared
    n-grams), less, more. Sets of a leader with many differences in all are dealt to blocks, and blocks meet in pairs."""
    weight = members.groupBy("leader").agg(F.sum(F.size("less") + F.size("more")).alias("weight"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    blocks = weight.filter("low != high").select("leader", F.ceil(F.greatest(F.col("weight"), F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(blocks, "leader").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    spread = dealt.withColumn("meets", F.explode(meets)).select("leader", "meets.i", "meets.j", "set_id", "n", "comp", "outside", "block", "size", "less", "more")
    return work.cut(spread.groupBy("leader", "i", "j").applyInArrow(lambda t: _around(t, percent), _LINKS), "links-around")


def _classes(work: Work, eligible: DataFrame, percent: int) -> DataFrame:
    """(node, comp) of the sets that have links."""
    need = F.expr(f"cast(({percent} * n + 99) div 100 as int)")
    own = ((F.col("n") - F.col("c")) / F.col("n")).alias("own")
    first = work.cut(eligible.select(F.explode(F.slice("keys", F.lit(1), F.col("c") - need + 1)).alias("key"), "set_id", "n", "c", own), "prefixes")
    # Lists of one set are done. What is joined by a list's key is a table on either side, so that Spark may split a long list.
    lead = F.min(F.struct("own", "set_id", "n", "c")).alias("lead")
    leads = work.cut(first.groupBy("key").agg(lead, F.count(F.lit(1)).alias("many")).filter("many > 1").drop("many"), "leads")
    none = work.spark.createDataFrame([], "node long, comp long")
    if leads.isEmpty():
        return none
    rows = work.cut(first.join(leads.select("key"), "key", "left_semi"), "lists")
    work.drop("prefixes")
    some = eligible.select(F.explode(F.filter("keys", lambda k, i: i % 16 == 0)).alias("key"))
    cuts = some.agg(F.percentile_approx("key", [k / PARTS for k in range(1, PARTS)], 1000).alias("cuts")).first()["cuts"] or []

    def placed(comps: DataFrame) -> DataFrame:
        return rows.join(comps, F.col("set_id") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "set_id")).drop("node")

    def opened(comps: DataFrame, name: str) -> DataFrame | None:
        """Rows of lists that hold more than one component; None if all lists are settled."""
        at = placed(comps)
        keys = at.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low != high").select("key")
        keys = work.cut(keys, f"open-{name}")
        return None if keys.isEmpty() else at.join(keys, "key")

    def grown(links: DataFrame, name: str) -> DataFrame:
        return components(work, links, name) if not links.isEmpty() else none

    # Each set meets the set with the fewest n-grams of its own among the leaders of its lists.
    met = rows.join(leads, "key").select(F.col("set_id").alias("a"), F.col("n").alias("an"), F.col("c").alias("ac"), F.col("lead.own").alias("own"), F.col("lead.set_id").alias("b"), F.col("lead.n").alias("bn"), F.col("lead.c").alias("bc"))
    met = met.filter("a != b").filter(_enough("a", "b", percent)).groupBy("a", "an").agg(F.min(F.struct("own", "b", "bn", "bc")).alias("x"))
    pairs = work.cut(met.select("a", "an", "x.b", "x.bn", F.col("x.bc").alias("size")), "pairs-leaders")
    compared = work.cut(_compared(pairs.drop("size"), eligible, cuts, True).withColumn("linked", _reaches(percent)), "compared")
    links = work.cut(compared.filter("linked").select("a", "b"), "links-leaders")
    comps = grown(links, "leaders")
    work.release()

    # Sets of unsettled lists that have one leader; a leader is its own.
    at = opened(comps, "leaders")
    if at is None:
        return comps
    open_rows = work.cut(at, "unsettled")
    leaders = pairs.select(F.col("b").alias("set_id"), F.col("size").alias("c")).distinct()
    open_sets = open_rows.select("set_id", "n", "comp").distinct()
    nothing = F.array().cast("array<long>")
    led = open_sets.join(compared.join(pairs.select("a", "size"), "a").select(F.col("a").alias("set_id"), F.col("b").alias("leader"), "size", "linked", "less", "more"), "set_id")
    led = led.join(leaders.select("set_id"), "set_id", "left_anti").select("set_id", "n", "comp", (~F.col("linked")).alias("outside"), "leader", "size", "less", "more")
    leading = open_sets.join(leaders, "set_id").select("set_id", "n", "comp", F.lit(False).alias("outside"), F.col("set_id").alias("leader"), F.col("c").alias("size"), nothing.alias("less"), nothing.alias("more"))
    members = work.cut(led.union(leading), "members")
    work.drop("compared")
    links = links.union(_by_leader(work, members, percent))
    comps = grown(links, "around")
    leader_of = work.cut(members.select("set_id", "leader"), "leader-of")
    work.drop("members")
    work.drop("unsettled")

    # What is left: pairs across components and leaders of which one set is outside its list's largest component.
    at = opened(comps, "around")
    if at is None:
        return comps
    at = work.cut(at.join(leader_of, "set_id", "left").withColumn("leader", F.coalesce("leader", "set_id")), "left")
    most = work.cut(at.groupBy("key", "comp").count().groupBy("key").agg(F.max(F.struct("count", "comp")).alias("x")).select("key", F.col("x.comp").alias("most")), "most")
    few, rest = (x.select("key", *(F.col(c).alias(f"{s}{c}") for c in ("set_id", "n", "c", "comp", "leader"))) for s, x in (("a", at.join(most, "key").filter("comp != most")), ("b", at)))
    met = few.join(rest, "key").filter((F.col("acomp") != F.col("bcomp")) & (F.col("aleader") != F.col("bleader")) & _enough("a", "b", percent))
    low = F.col("aset_id") < F.col("bset_id")
    ordered = met.select(*(F.when(low, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("aset_id", "bset_id", "a"), ("bset_id", "aset_id", "b"), ("an", "bn", "an"), ("bn", "an", "bn")))).distinct()
    pairs = work.cut(ordered, "pairs-left")
    fresh = work.cut(_compared(pairs, eligible, cuts, False).filter(_reaches(percent)).select("a", "b"), "links-left")
    work.drop("left")
    work.drop("pairs-left")
    if fresh.isEmpty():
        return comps
    return grown(work.cut(links.union(fresh), "links"), "all")


def ngram_jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, without the text, with n_shingles and component_id, the least key that can be reached by links of at least
    `percent` Jaccard similarity on distinct n-grams of lower-cased words."""
    spark = docs.sparkSession
    work = Work(spark, "ngram-join")
    bounded_batches(spark)
    _, size = text_bytes(docs, text)
    fragments = max(1, -(-size // FRAGMENT))
    shared = shared_ngrams(docs, n, percent, fragments, text).withColumn("c", F.size("keys"))
    eligible = work.cut(shared, "eligible")
    work.release()
    comps = work.cut(_classes(work, eligible, percent), "classes")
    for table in ("eligible", "lists", "leads"):
        work.drop(table)
    kept = [c for c in docs.columns if c not in (text, "n_shingles", "component_id")]
    own = docs.select(aside(kept), F.col(key).alias("_key"), F.col(text).alias("_text"))
    nodes = work.cut(with_sets(own, n, "_text"), "nodes")
    placed = nodes.join(comps, nodes["_set"] == comps["node"], "left").withColumn("_comp", F.coalesce("comp", "_set")).drop("node", "comp", "_set")
    # A table of its own, so that the rows of a large component may be split in the join.
    least = work.cut(placed.filter("_n > 0").groupBy("_comp").agg(F.min("_key").alias("_least")), "least")
    linked = placed.filter("_n > 0").join(least, "_comp").drop("_comp")
    empty = placed.filter("_n = 0").drop("_comp").withColumn("_least", F.col("_key"))
    return linked.select(*empty.columns).union(empty).select(*restored(kept), F.col("_n").alias("n_shingles"), F.col("_least").alias("component_id"))
