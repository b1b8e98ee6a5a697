"""Similarity join on word shingles: rare-first prefix filtering, verified once per pair."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.spread import components, spread_lookup, tasks
from clickweave.llm.text import LOWER, WHITE_SPACE, Words, mix, pieces, window_hashes, word_hashes, words
from clickweave.llm.text import _word_powers as _powers
from clickweave.plans.scratch import discard, materialize, scratch_path

SHINGLE_WORDS = 5
# two sets link when 100 * intersection >= PERCENT * union
PERCENT = 80
# shingles of candidate groups that one verification task holds; larger groups are cut into tiles
TILE_SHINGLES = 1 << 20
TILE_SETS = 1 << 13
# a list of document ids up to this many rows is broadcast to the text scan, a longer one is shuffled
BROADCAST_ROWS = 1 << 19
# classes of shingle order over which overlap is bounded before it is counted
SUFFIX_PARTS = 16

_KEY = np.dtype("V16")
_COUNTED = np.dtype([("key", _KEY), ("n", np.int64), ("c", np.int64)])


def _least(n, percent: int):
    """Least intersection of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def _allowance(n):
    """How many common shingles the first filter asks of two sets; grows with the set."""
    return 1 + n // 20


# ------------------------------------------------------------------ shingle sets


def _sets(data: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a piece."""
    data = LOWER[data]
    found: Words = words(data, bounds, WHITE_SPACE)
    hashes = word_hashes(data, found.start, found.end)
    windows, at = window_hashes(hashes, found.text, k)
    cuts = np.searchsorted(at, found.first)
    counts = np.diff(found.first)
    power, _ = _powers.upto(k)
    sets = []
    for i, n in enumerate(counts):
        if n >= k:
            sets.append(np.unique(windows[cuts[i] : cuts[i + 1]]))
        else:
            short = hashes[found.first[i] : found.first[i + 1]]
            whole = mix(np.sum(short * power[:n], dtype=np.uint64, keepdims=True) + np.uint64(n))
            sets.append(whole if n else whole[:0])
    return sets


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _batch_sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    for piece in pieces(batch.column("text")):
        yield from _sets(piece.data, piece.bounds, k)


def _identities(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, digest) per row; equal digests are equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for shingles in _batch_sets(batch, k):
                sizes.append(len(shingles))
                digests.append(_digest(shingles))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                ["doc_id", "n", "digest"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, digest binary")


# ------------------------------------------------------------------ which sets can have a partner


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(len(columns[0]), dtype=bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _rows(names: list[str], columns: list[list]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "unit": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(n, pa.binary())) for n, c in zip(names, columns)], names
    )


def _low_shingles(docs: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """Deal the lowest shingles of every set to buckets of hash values.

    Of the sets of a batch each digest counts once, and each shingle travels
    once: where two sets of the batch have it, their counts are known here and
    pass through (``known``), and only the shingle itself goes out (``seen``).
    """
    names = ["bucket", "digests", "sizes", "counts", "shingles", "seen", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, sizes, digests = [], [], {}
            for shingles in _batch_sets(batch, k):
                n = len(shingles)
                if n and (key := _digest(shingles)) not in digests:
                    digests[key] = len(sizes)
                    sizes.append(n)
                    least = _least(n, percent)
                    lows.append(shingles[: n - least + _allowance(n)].copy())
            if not lows:
                continue
            keys = np.frombuffer(b"".join(digests), dtype=_KEY)
            sizes = np.array(sizes, dtype=np.int64)
            values = np.concatenate(lows)
            owner = np.repeat(np.arange(len(lows)), [len(x) for x in lows])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            begin = _runs(values)
            length = np.diff(np.append(begin, len(values)))
            single = np.repeat(length == 1, length)
            local = np.bincount(owner[~single], minlength=len(keys))
            seen = values[begin[length > 1]]
            at = np.flatnonzero(local)
            known = np.zeros(len(at), dtype=_COUNTED)
            known["key"], known["n"], known["c"] = keys[at], sizes[at], local[at]
            values, owner = values[single], owner[single]
            to = (values % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((owner, to))
            values, owner, to = values[order], owner[order], to[order]
            seen_to = (seen % np.uint64(buckets)).astype(np.int64)
            cuts = np.searchsorted(to, np.arange(buckets + 1))
            shares = np.linspace(0, len(known), buckets + 1).astype(np.int64)
            columns: list[list] = [[] for _ in names]
            for b in range(buckets):
                own = owner[cuts[b] : cuts[b + 1]]
                first = _runs(own)
                row = [
                    b,
                    keys[own[first]].tobytes(),
                    sizes[own[first]].tobytes(),
                    np.diff(np.append(first, len(own))).tobytes(),
                    values[cuts[b] : cuts[b + 1]].tobytes(),
                    seen[seen_to == b].tobytes(),
                    known[shares[b] : shares[b + 1]].tobytes(),
                ]
                for column, value in zip(columns, row):
                    column.append(value)
            yield _rows(names, columns)

    schema = "bucket int, " + ", ".join(f"{n} binary" for n in names[1:])
    return docs.select("text").mapInArrow(run, schema)


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    blob = b"".join(table.column(name).to_pylist())
    return np.frombuffer(blob, dtype=kind) if blob else np.zeros(0, dtype=kind)


def _key_numbers(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 16-byte keys (index of one of each) and the number of every key among them."""
    halves = keys.view(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    begin = _runs(halves[order, 0], halves[order, 1])
    numbers = np.empty(len(keys), dtype=np.int64)
    numbers[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(keys))))
    return order[begin], numbers


def _shared_counts(units: int):
    """How many of its low shingles each set of a bucket shares, dealt by set."""

    def run(table: pa.Table) -> pa.Table:
        keys, sizes = _joined(table, "digests", _KEY), _joined(table, "sizes", np.int64)
        counts = _joined(table, "counts", np.int64)
        shingles, seen = _joined(table, "shingles", np.uint64), _joined(table, "seen", np.uint64)
        known = _joined(table, "known", _COUNTED)
        one, numbers = _key_numbers(keys)
        owner = np.repeat(numbers, counts)
        # a set that several batches hold counts once per shingle
        order = np.lexsort((owner, shingles))
        shingles, owner = shingles[order], owner[order]
        first = _runs(shingles, owner)
        shingles, owner = shingles[first], owner[first]
        begin = _runs(shingles)
        length = np.diff(np.append(begin, len(shingles)))
        seen = np.unique(seen)
        heads = shingles[begin]
        place = np.minimum(np.searchsorted(seen, heads), max(0, len(seen) - 1))
        elsewhere = seen[place] == heads if len(seen) else np.zeros(len(heads), dtype=bool)
        shared = np.repeat((length > 1) | elsewhere, length)
        found = np.bincount(owner[shared], minlength=len(one))
        at = np.flatnonzero(found)
        own = np.zeros(len(at), dtype=_COUNTED)
        own["key"], own["n"], own["c"] = keys[one[at]], sizes[one[at]], found[at]
        all_counts = np.concatenate((own, known))
        halves = np.ascontiguousarray(all_counts["key"]).view(np.uint64).reshape(-1, 2)
        to = (halves[:, 0] % np.uint64(units)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(units + 1))
        full = np.flatnonzero(np.diff(cuts)).tolist()
        blobs = [all_counts[order[cuts[u] : cuts[u + 1]]].tobytes() for u in full]
        return pa.Table.from_batches([_rows(["unit", "counts"], [full, blobs])])

    return run


def _open_sets(percent: int):
    """Of a unit of sets, those that share enough low shingles to link to any other."""

    def run(table: pa.Table) -> pa.Table:
        counts = _joined(table, "counts", _COUNTED)
        keys = np.ascontiguousarray(counts["key"])
        one, numbers = _key_numbers(keys)
        shared = np.bincount(numbers, weights=counts["c"], minlength=len(one))
        keys, n = keys[one], counts["n"][one]
        ok = shared >= _allowance(_least(n, percent))
        return pa.table({"digest": pa.array([k.tobytes() for k in keys[ok]], pa.binary())})

    return run


# ------------------------------------------------------------------ candidates among those


def _full_sets(docs: DataFrame, k: int, units: int) -> DataFrame:
    """(digest, n, shingles, unit) of given documents; a digest comes once per task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            # rows that repeat an id, or have none, may be copies
            fresh = {d: s for s in _batch_sets(batch, k) if (d := _digest(s)) not in seen}
            seen.update(fresh)
            digests, sets = list(fresh), list(fresh.values())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([int.from_bytes(d[:8], "little") % units for d in digests], pa.int32()),
                ],
                ["digest", "n", "shingles", "unit"],
            )

    return docs.select("text").mapInArrow(run, "digest binary, n bigint, shingles binary, unit int")


def _deal(names: list[str], to: np.ndarray, buckets: int, columns: dict[str, np.ndarray], fixed: dict) -> pa.Table:
    """One row per bucket that gets something: slices of parallel columns."""
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(buckets + 1))
    moved = {n: c[order] for n, c in columns.items()}
    rows: list[list] = [[] for _ in names]
    for b in np.flatnonzero(np.diff(cuts)):
        values = {"bucket": int(b)} | fixed | {n: c[cuts[b] : cuts[b + 1]].tobytes() for n, c in moved.items()}
        for column, name in zip(rows, names):
            column.append(values[name])
    return pa.Table.from_batches([_rows(names, rows)])


def _count_in_unit(buckets: int):
    """Frequencies of the shingles of one unit of sets, dealt by shingle."""

    def run(table: pa.Table) -> pa.Table:
        values, counts = np.unique(_joined(table, "shingles", np.uint64), return_counts=True)
        to = (values % np.uint64(buckets)).astype(np.int64)
        unit = table.column("unit")[0].as_py()
        names = ["bucket", "unit", "shingles", "counts"]
        return _deal(names, to, buckets, {"shingles": values, "counts": counts.astype(np.int64)}, {"unit": unit})

    return run


def _total_counts(table: pa.Table) -> pa.Table:
    """Add the frequencies of a bucket over all units; tell each unit those of 2 and more."""
    parts = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
    counts = _joined(table, "counts", np.int64)
    values, numbers = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(numbers, weights=counts).astype(np.int64)
    rows: list[list] = [[], [], []]
    at = 0
    for unit, part in zip(table.column("unit").to_pylist(), parts):
        own = total[numbers[at : at + len(part)]]
        at += len(part)
        rows[0].append(unit)
        rows[1].append(part[own > 1].tobytes())
        rows[2].append(own[own > 1].tobytes())
    return pa.Table.from_batches([_rows(["unit", "shared", "totals"], rows)])


def _unite(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (smallest member) of ``count`` nodes under edges a-b."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            return label
        label = new


def _compatible(value: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Places i where row i and i+1 (sorted by value, n) may link: same value, sizes close enough."""
    return np.flatnonzero((value[1:] == value[:-1]) & (n[:-1] >= _least(n[1:], percent)))


def _prefix_links(percent: int, buckets: int):
    """Rare-first prefixes of a unit's sets; sets that share a prefix shingle meet, here or in a bucket."""
    names = ["bucket", "values", "keys", "sizes", "edges"]

    def run(sets: pa.Table, shared: pa.Table) -> pa.Table:
        values, totals = _joined(shared, "shared", np.uint64), _joined(shared, "totals", np.int64)
        order = np.argsort(values)
        values, totals = values[order], totals[order]
        keys = _joined(sets, "digest", _KEY)
        sizes = sets.column("n").to_numpy()
        value, owner = [], []
        for i, blob in enumerate(sets.column("shingles").to_pylist()):
            own = np.frombuffer(blob, np.uint64)
            place = np.searchsorted(values, own)
            ok = place < len(values)
            ok[ok] = values[place[ok]] == own[ok]
            n = len(own)
            # shingles that no other set has come first in the order and take their part of the prefix
            room = n - _least(n, percent) + 1 - (n - int(ok.sum()))
            if room > 0:
                own, total = own[ok], totals[place[ok]]
                value.append(own[np.lexsort((own, total))[:room]])
                owner.append(np.full(len(value[-1]), i))
        if not value:
            return pa.Table.from_batches([_rows(names, [[] for _ in names])])
        value, owner = np.concatenate(value), np.concatenate(owner)
        order = np.lexsort((sizes[owner], value))
        value, owner = value[order], owner[order]
        near = _compatible(value, sizes[owner], percent)
        label = _unite(len(keys), owner[near], owner[near + 1])
        moved = np.flatnonzero(label != np.arange(len(keys)))
        edges = np.concatenate((keys[moved], keys[label[moved]]))
        # sets of one size that share the shingle are together already: one of them goes on
        first = _runs(value, sizes[owner])
        value, owner = value[first], owner[first]
        to = (value % np.uint64(buckets)).astype(np.int64)
        columns = {"values": value, "keys": keys[owner], "sizes": sizes[owner]}
        dealt = _deal(names, to, buckets, columns, {"edges": b""})
        own_bucket = int.from_bytes(keys[0].tobytes()[8:], "little") % buckets
        extra = _rows(names, [[own_bucket], [b""], [b""], [b""], [edges.tobytes()]])
        return pa.concat_tables([dealt, pa.Table.from_batches([extra])])

    return run


def _bucket_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        value = _joined(table, "values", np.uint64)
        keys, sizes = _joined(table, "keys", _KEY), _joined(table, "sizes", np.int64)
        order = np.lexsort((sizes, value))
        one, numbers = _key_numbers(keys)
        value, sizes, numbers = value[order], sizes[order], numbers[order]
        near = _compatible(value, sizes, percent)
        label = _unite(len(one), numbers[near], numbers[near + 1])
        moved = np.flatnonzero(label != np.arange(len(one)))
        a, b = [keys[one[moved]]], [keys[one[label[moved]]]]
        for blob in table.column("edges").to_pylist():
            if blob:
                pair = np.frombuffer(blob, _KEY).reshape(2, -1)
                a.append(pair[0])
                b.append(pair[1])
        return pa.table(
            {n: pa.array([k.tobytes() for k in np.concatenate(c)], pa.binary()) for n, c in (("a", a), ("b", b))}
        )

    return run


# ------------------------------------------------------------------ verification


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The representative of each node's class."""
    found = parent[nodes]
    while (parent[found] != found).any():
        found = parent[found]
    return found


def _links(
    sets: list[np.ndarray], copies: np.ndarray, tile: np.ndarray, cross: bool, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """A member of the class of each set, and the copies that it links to; or only by links across two tiles.

    Sets are taken by size.  Candidates share a shingle of both rare-first
    prefixes, have compatible sizes, and could still overlap enough after their
    first common shingle (positional) and by their counts per part of the
    order (suffix).  Only then are the common shingles counted, once per pair.
    The pairs of one set are folded into classes and counts before the next one's.
    """
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size, weight, tile = size[order], copies[order], tile[order]
    parent, counts = np.arange(len(sets)), np.zeros(len(sets), dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, number, total = np.unique(
        np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True
    )
    rank = np.empty(len(total), dtype=np.int64)
    rank[np.argsort(total, kind="stable")] = np.arange(len(total))
    alone = int((total == 1).sum())
    value = rank[number]
    several = value >= alone
    value, owner = value[several] - alone, owner[several]
    by_set = np.lexsort((value, owner))
    value, owner = value[by_set], owner[by_set]
    cuts = np.searchsorted(owner, np.arange(len(sets) + 1))
    place = np.arange(len(owner)) - cuts[owner] + (size - np.diff(cuts))[owner]
    in_prefix = place < (size - _least(size, percent) + 1)[owner]
    # posting lists: of all common shingles, and of those in prefixes
    by_value = np.lexsort((owner, value))
    every, every_cuts = owner[by_value], np.searchsorted(value[by_value], np.arange(len(total) - alone + 1))
    by_prefix = by_value[in_prefix[by_value]]
    prefix, prefix_place = owner[by_prefix], place[by_prefix]
    prefix_cuts = np.searchsorted(value[by_prefix], np.arange(len(total) - alone + 1))
    part = value * SUFFIX_PARTS // max(1, len(total) - alone)
    parts = np.bincount(owner * SUFFIX_PARTS + part, minlength=len(sets) * SUFFIX_PARTS)
    parts = parts.reshape(-1, SUFFIX_PARTS)
    for i in range(1, len(sets)):
        own = value[cuts[i] : cuts[i + 1]]
        mine = own[in_prefix[cuts[i] : cuts[i + 1]]]
        if not len(mine):
            continue
        spans = [(prefix_cuts[v], prefix_cuts[v + 1]) for v in mine]
        others = np.concatenate([prefix[a:b] for a, b in spans])
        if not (others < i).any():
            continue
        theirs = np.concatenate([prefix_place[a:b] for a, b in spans])
        ours = np.repeat(place[cuts[i] : cuts[i] + len(mine)], [b - a for a, b in spans])
        j, first = np.unique(others, return_index=True)
        first, j = first[j < i], j[j < i]
        needed = -(-percent * (size[i] + size[j]) // (100 + percent))
        ok = size[j] >= _least(size[i], percent)
        ok &= np.minimum(size[i] - ours[first], size[j] - theirs[first]) >= needed
        if cross:
            ok &= tile[j] != tile[i]
        j, needed = j[ok], needed[ok]
        ok = np.minimum(parts[i], parts[j]).sum(axis=1) >= needed
        j, needed = j[ok], needed[ok]
        if not len(j):
            continue
        if len(j) <= 4:
            common = np.array(
                [len(np.intersect1d(own, value[cuts[x] : cuts[x + 1]], assume_unique=True)) for x in j]
            )
        else:
            lists = np.concatenate([every[every_cuts[v] : every_cuts[v + 1]] for v in own])
            common = np.bincount(lists, minlength=len(sets))[j]
        j = j[common >= needed]
        if len(j):
            counts[i] += weight[j].sum()
            counts[j] += weight[i]
            met = np.append(j, i)
            heads = _roots(parent, met)
            parent[heads] = parent[met] = heads.min()
    label, links = np.empty_like(parent), np.empty_like(counts)
    label[order], links[order] = order[_roots(parent, np.arange(len(sets)))], counts
    return label, links


def _verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.take(_key_numbers(_joined(table, "digest", _KEY))[0])
        group = _joined(table, "root", _KEY)
        keys, copies = _joined(table, "digest", _KEY), table.column("copies").to_numpy()
        tile = table.column("tile").to_numpy()
        cross = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        sets = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
        one, numbers = _key_numbers(group)
        order = np.argsort(numbers, kind="stable")
        ends = np.append(_runs(numbers[order]), len(order))
        label, links = np.arange(len(keys)), np.zeros(len(keys), dtype=np.int64)
        for a, b in zip(ends[:-1], ends[1:]):
            own = order[a:b]
            members, links[own] = _links([sets[i] for i in own], copies[own], tile[own], cross, percent)
            label[own] = own[members]
        at = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array([k.tobytes() for k in keys[at]], pa.binary()),
                "b": pa.array([k.tobytes() for k in keys[label[at]]], pa.binary()),
                "links": pa.array(links[at], pa.int64()),
            }
        )

    return run


def _candidate_edges(sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """Edges (a, b) between digests; all sets that can link are in one component of them."""
    by_unit = sets.groupBy("unit")
    counted = by_unit.applyInArrow(
        _count_in_unit(parts), "bucket int, unit int, shingles binary, counts binary"
    )
    shared = counted.groupBy("bucket").applyInArrow(_total_counts, "unit int, shared binary, totals binary")
    met = by_unit.cogroup(shared.groupBy("unit")).applyInArrow(
        _prefix_links(percent, parts), "bucket int, values binary, keys binary, sizes binary, edges binary"
    )
    return met.groupBy("bucket").applyInArrow(_bucket_links(percent), "a binary, b binary")


def _small(table: DataFrame, broadcast_rows: int) -> DataFrame:
    """A join hint for a written table of short rows, by its measured size."""
    return F.broadcast(table) if table.count() <= broadcast_rows else table.hint("shuffle_hash")


def _verified(sets: DataFrame, places: DataFrame, parts: int, percent: int) -> DataFrame:
    """(a, b, links): of each linked set, a member of its local class, and how many rows it links to."""
    met = sets.drop("unit").join(places, "digest")
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    slot = F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("root"), F.lit(4 * parts))).otherwise(F.xxhash64("root"))
    return (
        met.select(
            "digest",
            "root",
            "shingles",
            "copies",
            "tile",
            slot.alias("slot"),
            F.least("tile", "other").alias("low"),
            F.greatest("tile", "other").alias("high"),
        )
        .groupBy("slot", "low", "high")
        .applyInArrow(_verify(percent), "a binary, b binary, links bigint")
    )


def _places(candidates: DataFrame, chosen: DataFrame, tile_shingles: int, tile_sets: int) -> DataFrame:
    """(digest, root, copies, tiles, tile) of every set that met another; a tile is bounded by shingles and by sets."""
    members = candidates.withColumnRenamed("node", "digest").join(chosen, "digest")
    needed = F.greatest(F.ceil(F.sum("n") / F.lit(tile_shingles)), F.ceil(F.count(F.lit(1)) / F.lit(tile_sets)))
    tiles = members.groupBy("root").agg(needed.cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("digest"), "tiles").cast("int")
    return members.join(tiles, "root").select("digest", "root", "copies", "tiles", tile.alias("tile"))


def jaccard_components(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    tile_shingles: int = TILE_SHINGLES,
    tile_sets: int = TILE_SETS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Near-duplicate classes of ``docs(doc_id, text)``: one row per row.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable by
    links, its own included) and n_links (rows it links to directly).  A set is
    the distinct runs of ``shingle_words`` words (between white space, A-Z
    lower-cased); a text of fewer words is one shingle; a null or empty text,
    or one of white space only, has an empty set and links to nothing.  Two
    rows link when 100 * intersection >= ``percent`` * union.  Rows that repeat
    id and text link to each other.  A row with a null doc_id takes part; it
    does not name its component while another member has an id.  Other columns
    are ignored; an empty table gives no rows.

    Equal sets are joined first and stand for one from then on.  A first pass
    looks only at the lowest hash values of each set, a fifth and a little
    more: two sets that link must share some of them, so a set that shares too
    few is done.  The others are ordered rare-first by their frequencies and
    meet on the shingles of their prefixes; what meets is grouped, and each
    group is verified in one task, or tile by tile, without emitting pairs.
    """
    spark = docs.sparkSession
    parts = tasks(spark)
    ids = materialize(_identities(docs, shingle_words), "jaccard-ids")
    classes = (
        ids.where("n > 0")
        .groupBy("digest", "n")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    )
    open_sets = (
        _low_shingles(docs, shingle_words, percent, parts)
        .groupBy("bucket")
        .applyInArrow(_shared_counts(parts), "unit int, counts binary")
        .groupBy("unit")
        .applyInArrow(_open_sets(percent), "digest binary")
    )
    # of each open set, one row that holds it
    chosen = materialize(classes.join(open_sets, "digest"), "jaccard-open")
    held = chosen.select(F.col("first_id").alias("doc_id")).where("doc_id is not null").distinct()
    held = materialize(held, "jaccard-held")
    source = docs.select("doc_id", "text")
    texts = source.join(_small(held, broadcast_rows), "doc_id", "left_semi")
    texts = texts.unionByName(source.where("doc_id is null"))
    sets_path = scratch_path(spark, "jaccard-sets")
    sets = materialize(_full_sets(texts, shingle_words, parts), "jaccard-sets", sets_path)
    candidates = components(_candidate_edges(sets, percent, parts))
    places = materialize(_places(candidates, chosen.drop("first_id"), tile_shingles, tile_sets), "jaccard-places")
    linked = materialize(_verified(sets, _small(places, broadcast_rows), parts, percent), "jaccard-links")
    discard(spark, sets_path)
    roots = components(linked).withColumnRenamed("node", "digest")
    n_links = linked.groupBy(F.col("a").alias("digest")).agg(F.sum("links").alias("links"))
    first = classes.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    smallest = first.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answers = (
        first.join(smallest, "root")
        .join(n_links, "digest", "left")
        .where("copies > 1 or links is not null")
        .select("digest", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    result = spread_lookup(ids, answers, "digest", "doc_id")
    return result.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
