"""Exact Jaccard self-join of word n-gram sets through prefix trees, and its connected groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import among, answers, bucket_count, by_hash, decode_rows, hash_entries, merged, merged_counts, pack, saved, slices, unpack
from emberfield.llm.components import components
from emberfield.llm.words import Windows, WordHashes, split_words

_COARSE = np.uint64(0xFFFFFFFFFFFF0000)  # a shared high part can only make a gram look more frequent


def _required(n, percent: int):
    """Smallest whole intersection of a set of size n with any linked set."""
    return -(-n * percent // 100)


def _gram_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    words, windows, sets = WordHashes(), Windows(size), []
    for text in texts:
        found = split_words(text, lower=True)
        if len(found) >= size:
            sets.append(np.unique(windows.of(words.of(found))))
        elif found:
            sets.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _joined(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(sets) if sets else np.empty(0, np.uint64)


class PrefixTree:
    """Sets as ascending code sequences, common prefixes stored once.

    A node holds a run of codes; a set ends at a node. ``overlaps`` carries the
    overlap with the probe down from parent to child, level by level, and leaves a
    subtree as soon as even its longest remaining run cannot reach the overlap that
    its smallest set would need.
    """

    def __init__(self, seqs: list[np.ndarray], sizes: np.ndarray, codes: int, percent: int):
        self.percent, self.sizes, self.codes = percent, sizes, codes
        order = sorted(range(len(seqs)), key=lambda i: seqs[i].astype(">u4").tobytes())
        parent, depth, first, last, level = [-1], [0], [0], [0], [0]  # depth: codes before and in the node
        runs: list[np.ndarray] = []
        self.end = np.zeros(len(seqs), np.int64)
        stack, previous, total = [0], np.empty(0, np.uint32), 0
        for i in order:
            seq = seqs[i]
            n = min(len(seq), len(previous))
            differ = np.flatnonzero(seq[:n] != previous[:n])
            common = int(differ[0]) if len(differ) else n
            while depth[stack[-1]] > common:
                node = stack.pop()
                above = stack[-1]
                if depth[above] < common:  # cut the node in two at the common length
                    cut = first[node] + common - depth[above]
                    parent.append(above), depth.append(common), first.append(first[node]), last.append(cut), level.append(0)
                    first[node], parent[node] = cut, len(parent) - 1
                    stack.append(len(parent) - 1)
            if len(seq) > common:
                runs.append(seq[common:])
                parent.append(stack[-1]), depth.append(len(seq)), first.append(total), last.append(total + len(seq) - common), level.append(0)
                total += len(seq) - common
                stack.append(len(parent) - 1)
            self.end[i] = stack[-1]
            previous = seq
        self.parent, self.depth = np.array(parent), np.array(depth)
        self.first, self.last = np.array(first), np.array(last)
        self.run = np.concatenate(runs) if runs else np.empty(0, np.uint32)
        level = np.array(level)
        by_depth = np.argsort(self.depth, kind="stable")  # a parent is never deeper than its child
        for node in by_depth[1:].tolist():
            level[node] = level[self.parent[node]] + 1
        self.levels = [np.flatnonzero(level == k) for k in range(1, int(level.max()) + 1)]
        self.smallest = np.full(len(parent), np.iinfo(np.int64).max)
        self.longest = np.zeros(len(parent), np.int64)
        np.minimum.at(self.smallest, self.end, sizes)
        np.maximum.at(self.longest, self.end, self.depth[self.end])
        for nodes in reversed(self.levels):
            np.minimum.at(self.smallest, self.parent[nodes], self.smallest[nodes])
            np.maximum.at(self.longest, self.parent[nodes], self.longest[nodes])

    def linked(self, seq: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the sets linked with a probe of ``size`` grams, of which ``seq`` may be shared."""
        in_probe = np.zeros(self.codes, np.int64)
        in_probe[seq] = 1
        hits = np.zeros(len(self.run) + 1, np.int64)
        np.cumsum(in_probe[self.run], out=hits[1:])
        overlap = np.zeros(len(self.parent), np.int64)
        alive = np.zeros(len(self.parent), bool)
        alive[0] = True
        whole, share = 100 + self.percent, self.percent
        for nodes in self.levels:
            nodes = nodes[alive[self.parent[nodes]]]
            if not len(nodes):
                break
            overlap[nodes] = overlap[self.parent[nodes]] + hits[self.last[nodes]] - hits[self.first[nodes]]
            most = overlap[nodes] + np.minimum(self.longest[nodes] - self.depth[nodes], len(seq) - overlap[nodes])
            alive[nodes] = whole * most >= share * (size + self.smallest[nodes])
        at = self.end
        return np.flatnonzero(alive[at] & (whole * overlap[at] >= share * (size + self.sizes)))


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _coded(grams: list[np.ndarray], freqs: list[np.ndarray]) -> list[np.ndarray]:
    """Dense codes in the global order, frequency first; ascending within each set."""
    gram, freq = np.concatenate(grams), np.concatenate(freqs)
    order = np.lexsort((gram, freq))
    new = np.append(True, (gram[order][1:] != gram[order][:-1]) | (freq[order][1:] != freq[order][:-1]))
    code = np.empty(len(gram), np.uint32)
    code[order] = np.cumsum(new) - 1
    return np.split(code, np.cumsum([len(g) for g in grams])[:-1])


def _probe_links(ids: list[int], sizes: np.ndarray, seqs: list[np.ndarray], codes: int, groups: list, percent: int) -> list[tuple[int, int]]:
    """One link from each probe (null group) to the sets of the tree, if it has any."""
    inside = [i for i, g in enumerate(groups) if g is not None]
    if not inside:
        return []
    tree = PrefixTree([seqs[i] for i in inside], sizes[inside], codes, percent)
    found = []
    for i, g in enumerate(groups):
        if g is None:
            hits = tree.linked(seqs[i], int(sizes[i]))
            if len(hits):
                found.append((ids[i], ids[inside[int(hits[0])]]))
    return found


def _unit_links(ids: list[int], sizes: np.ndarray, seqs: list[np.ndarray], codes: int, groups: list, percent: int) -> list[tuple[int, int]]:
    """Links that join the unit's sets into their groups; sets of one given group count as joined.

    A link between two groups has an end outside the largest one, so probing every
    set outside it finds all of them.
    """
    up = list(range(len(ids)))
    by_group: dict[int, int] = {}
    for i, g in enumerate(groups):
        up[i] = by_group.setdefault(g, i)
    if len(by_group) < 2:
        return []
    tree = PrefixTree(seqs, sizes, codes, percent)
    found, probed = [], set()
    while True:
        roots = [_root(up, i) for i in range(len(ids))]
        members: dict[int, int] = {}
        for r in roots:
            members[r] = members.get(r, 0) + 1
        largest = max(members, key=lambda r: (members[r], -r))
        todo = [i for i, r in enumerate(roots) if r != largest and i not in probed]
        if not todo:
            return found
        before = len(found)
        for i in todo:
            probed.add(i)
            for j in tree.linked(seqs[i], int(sizes[i])).tolist():
                a, b = _root(up, i), _root(up, j)
                if a != b:
                    up[max(a, b)] = min(a, b)
                    found.append((ids[i], ids[j]))
            if len(found) - before > len(ids) // 2:  # the largest group has changed: look again what is left
                break


def _join_units(units: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) within each unit; ``units``: unit struct columns t, i, j and id, n, label, grams, freqs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def flush():
            if len(rows) < 2:
                return []
            ids, n, label, grams, freqs = zip(*rows, strict=True)
            seqs = _coded([unpack(g) for g in grams], [unpack(f, np.uint32) for f in freqs])
            codes = 1 + max(int(s[-1]) for s in seqs)
            links = _probe_links if None in label else _unit_links
            return links(list(ids), np.array(n, np.int64), seqs, codes, list(label), percent)

        def out(edges):
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])

        for batch in slices(batches, 200):
            edges = []
            columns = [batch.column(c).to_pylist() for c in range(8)]
            for t, i, j, *row in zip(*columns, strict=True):
                if (t, i, j) != key:
                    edges += flush()
                    key, rows = (t, i, j), []
                rows.append(row)
            yield out(edges)
        yield out(flush())

    ordered = units.select("t", "i", "j", "id", "n", "label", "grams", "freqs").repartition("t", "i", "j").sortWithinPartitions("t", "i", "j")
    return ordered.mapInArrow(run, "a long, b long")


def _first_wave(sets: DataFrame, block: int, unit_bytes: int) -> DataFrame:
    """Units by each set's rarest shared gram. A large group is dealt into blocks that share its smallest id.

    These links need not be complete; they join most groups of copies, in time proportional to their size.
    """
    first = sets.select("id", F.col("prefix")[0].alias("t"), F.octet_length("grams").alias("w"))
    groups = first.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("pivot"), F.sum("w").alias("all_w")).where("c > 1")
    blocks = F.greatest(F.ceil(F.col("c") / F.lit(block)), F.ceil(F.col("all_w") / F.lit(unit_bytes))).cast("int")
    to = F.when((F.col("id") == F.col("pivot")) & (blocks > 1), F.sequence(F.lit(0), blocks - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("id"), blocks).cast("int"))
    )
    dealt = first.join(groups, "t").select("id", "t", F.explode(to).alias("i"), F.lit(0).alias("j"))
    return dealt.join(sets.drop("prefix"), "id").withColumn("label", F.col("id"))


def _met_groups(sets: DataFrame, posted: DataFrame, few: DataFrame, percent: int, unit_bytes: int) -> DataFrame:
    """Units of one group as the tree and the sets of smaller groups that may link with it as probes.

    A set probes a group if they meet at as many prefix grams as a link needs at
    least. Group and probes are dealt into blocks of about ``unit_bytes``; every block of probes meets every block of the group.
    """
    here = posted.join(few.select("t"), "t", "left_semi")
    labels = here.groupBy("t", "label", "members").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    larger = labels.select("t", F.col("label").alias("to"), F.col("members").alias("to_members"), "low", "high")
    met = (
        here.join(larger, "t")
        .where(F.struct("members", "label") < F.struct("to_members", "to"))
        .groupBy("id", "to")
        .agg(F.count(F.lit(1)).alias("meets"), F.first("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    part = F.lit(percent)
    low = F.greatest("low", F.ceil(F.col("n") * part / 100))
    high = F.least("high", F.floor(F.col("n") * 100 / part))

    def least(n):
        both = F.ceil((F.col("n") + n) * part / (100 + part))
        return both - F.greatest(F.ceil(F.col("n") * part / 100), F.ceil(n * part / 100)) + 1

    # Up to n least(m) is smallest at low. Above n it may rise by one from a size to the next, but from 50 % on never over
    # two sizes, so high or the size before it has the smallest value; below 50 % no value is smaller than that of high by more than one.
    end = F.least(least(high), least(F.greatest(low, high - 1))) if percent >= 50 else least(high) - 1
    met = saved(met.where((low <= high) & (F.col("meets") >= F.least(least(low), end))).select("id", "to"), "met")
    weight = F.octet_length("grams") + 100
    probes = met.join(sets.select("id", weight.alias("w")), "id").groupBy("to").agg(F.sum("w").alias("w_out"))
    group = posted.select("id", F.col("label").alias("to")).distinct().join(met.select("to").distinct(), "to", "left_semi")
    inside = group.join(sets.select("id", weight.alias("w")), "id").groupBy("to").agg(F.sum("w").alias("w_in"))
    blocks = saved(
        inside.join(probes, "to").select("to", F.ceil(F.col("w_in") / unit_bytes).cast("int").alias("k_in"), F.ceil(F.col("w_out") / unit_bytes).cast("int").alias("k_out")), "blocks"
    )
    mine = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    tree = group.join(blocks, "to").select("id", F.col("to").alias("t"), mine("k_in").alias("i"), F.explode(F.sequence(F.lit(0), F.col("k_out") - 1)).alias("j"), F.col("to").alias("label"))
    probe = met.join(blocks, "to").select("id", F.col("to").alias("t"), F.explode(F.sequence(F.lit(0), F.col("k_in") - 1)).alias("i"), mine("k_out").alias("j"), F.lit(None).cast("long").alias("label"))
    return tree.unionByName(probe).join(sets.drop("prefix"), "id")


def _mixed_blocks(sets: DataFrame, posted: DataFrame, many: DataFrame, block: int) -> DataFrame:
    """Units of grams that sets of many groups share: all sets outside the gram's largest group against all, in blocks."""
    member = posted.join(many, "t")
    inside = F.col("label") == F.col("main")
    k_in = F.ceil(F.col("c_main") / F.lit(block)).cast("int")
    k_out = F.ceil((F.col("c") - F.col("c_main")) / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64("id"), F.when(inside, k_in).otherwise(k_out)).cast("int")
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    units = (
        F.when(F.col("c") <= 2 * block, F.array(pair(F.lit(0), F.lit(0))))
        .when(inside, F.transform(F.sequence(F.lit(0), k_out - 1), lambda m: pair(F.col("mine"), m)))
        .otherwise(
            F.concat(
                F.transform(F.sequence(F.lit(0), k_in - 1), lambda d: pair(d, F.col("mine"))),
                F.transform(F.sequence(F.lit(0), k_out - 1), lambda m: pair(-1 - F.least(F.col("mine"), m), F.greatest(F.col("mine"), m))),
            )
        )
    )
    dealt = member.withColumn("mine", mine).select("t", "id", "label", F.explode(units).alias("u")).select("t", "u.i", "u.j", "id", "label")
    return dealt.join(sets.drop("prefix"), "id")


def _second_wave(sets: DataFrame, labels: DataFrame, percent: int, block: int, unit_bytes: int, few_labels: int) -> DataFrame:
    """All links between the groups of the first wave, or enough of them to join what is linked."""
    sized = saved(labels.join(labels.groupBy("component").agg(F.count(F.lit(1)).alias("members")), "component"), "sized")
    posted = saved(
        sets.select("id", "n", F.explode("prefix").alias("t"))
        .join(sized.withColumnRenamed("node", "id"), "id", "left")
        .select("t", "id", "n", F.coalesce("component", "id").alias("label"), F.coalesce("members", F.lit(1)).alias("members")),
        "postings",
    )
    mixed = saved(
        posted.groupBy("t", "label").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("t").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("labels"), F.max(F.struct("c", "label")).alias("top")).where("labels > 1")
        .select("t", "c", "labels", F.col("top.label").alias("main"), F.col("top.c").alias("c_main")),
        "mixed",
    )
    few, many = F.col("labels") <= few_labels, F.col("labels") > few_labels
    met = _met_groups(sets, posted, mixed.where(few), percent, unit_bytes)
    return _join_units(met, percent).unionByName(_join_units(_mixed_blocks(sets, posted, mixed.where(many), block), percent))


def similar_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    chunk_bytes: int = 6 << 20,
    bucket_words: int = 750_000,
    block: int = 256,
    unit_bytes: int = 4 << 20,
    few_labels: int = 64,
) -> DataFrame:
    """Groups of texts whose sets of word n-grams are linked by Jaccard similarity.

    Two texts link when 100 * intersection >= percent * union, exactly. Steps:

    1. Count in how many texts each n-gram occurs. A text of n grams can only link
       if at least percent % of its grams occur elsewhere; most texts end here.
    2. Equal sets become one set, named by its hash.
    3. Grams are ordered by their frequency among the sets left, rarest first. Two
       linked sets share a gram of their prefixes, the first n - required + 1 grams.
    4. Sets sharing a prefix gram meet in a unit of bounded size. There they form a
       prefix tree that is probed with the sets not yet joined to the rest. First by
       the rarest gram only. Then each group found is probed with the sets of smaller
       groups that share enough prefix grams with it; prefix grams that more than
       ``few_labels`` groups share are joined in blocks instead.
    5. The links found join all groups; links inside a joined group are not listed.

    Returns (id, n_shingles, component_id, text_hash, group): one row per input row; the component is
    the smallest id reachable. ``text_hash`` is xxhash64 of the text, which tells rows of one id apart, and
    ``group`` names the group itself (null for a text that can't link), which two groups with one smallest id don't share. Words are lower-cased in A-Z only; a text with
    fewer than ``size`` words is one gram; null, empty or blank texts have none and link with nothing.
    Rows with a null id get a null component and link with nothing. Repeated rows
    are all returned, and rows with one id but different texts are judged each by its own
    text. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = by_hash(docs, F.struct("id", "text_hash"), max(1, -(-total // chunk_bytes)))
    buckets = bucket_count(spark, total, bucket_words * 6)

    def coarse(rows: pa.Table) -> np.ndarray:
        return _joined(_gram_sets(rows["text"].to_pylist(), size)) & _COARSE

    def elsewhere(hashes, chunk, counts):
        same = hashes[1:] == hashes[:-1]
        return (np.append(False, same) | np.append(same, False))[: len(hashes)], counts

    replies = answers(hash_entries(chunks, coarse, buckets), elsewhere)

    def screen(key, left, right):
        rows = decode_rows(left["rows"].to_pylist())
        sets = _gram_sets(rows["text"].to_pylist(), size)
        flat = _joined(sets) & _COARSE
        here, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        shared = ((counts > 1) | among(here, merged(right["hashes"].to_pylist())))[inverse]
        at, prints, grams = 0, [], []
        for s, known in zip(sets, rows["id"].is_valid().to_pylist(), strict=True):
            mine = s[shared[at : at + len(s)]]
            at += len(s)
            candidate = known and len(s) and len(mine) >= _required(len(s), percent)
            prints.append(_signed(xxhash.xxh3_64_intdigest(s.tobytes())) if candidate else None)
            grams.append(mine.tobytes() if candidate else None)
        return pa.table({"id": rows["id"], "text_hash": rows["text_hash"], "n": pa.array([len(s) for s in sets], pa.int64()), "print": pa.array(prints, pa.int64()), "grams": pa.array(grams, pa.binary())})

    screened = saved(chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(screen, "id long, text_hash long, n long, print long, grams binary"), "screened")
    candidates = screened.where("print is not null")
    held = saved(candidates.groupBy("print").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("grams").alias("grams")), "held")
    classes = held.select("print", "rep")
    held = held.select(F.col("print").alias("id"), "n", "grams")

    gram_bytes = held.agg(F.sum(F.octet_length("grams"))).first()[0] or 0
    packed = by_hash(held, F.col("id"), max(1, -(-gram_bytes // chunk_bytes)))

    def fine(rows: pa.Table) -> np.ndarray:
        return _joined([np.frombuffer(g, np.uint64) for g in rows["grams"].to_pylist()])

    def frequent(hashes, chunk, counts):
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        sums = np.add.reduceat(counts.astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
        whole = np.repeat(sums, np.diff(np.append(starts, len(hashes))))
        return whole > 1, np.minimum(whole, np.iinfo(np.uint32).max)

    known = answers(hash_entries(packed, fine, bucket_count(spark, gram_bytes, bucket_words * 8)), frequent)

    def order(key, left, right):
        rows = decode_rows(left["rows"].to_pylist())
        hashes, counts = merged_counts(right)
        out: dict[str, list] = {"id": [], "n": [], "grams": [], "freqs": [], "prefix": []}
        for i, n, blob in zip(rows["id"].to_pylist(), rows["n"].to_pylist(), rows["grams"].to_pylist(), strict=True):
            mine = np.frombuffer(blob, np.uint64)
            mine = mine[among(mine, hashes)]
            need = _required(n, percent)
            if len(mine) < need:
                continue
            freq = counts[np.searchsorted(hashes, mine)]
            by = np.lexsort((mine, freq))
            mine, freq = mine[by], freq[by]
            for name, value in zip(out, (i, n, pack(mine), pack(freq), mine[: len(mine) - need + 1].view(np.int64)), strict=True):
                out[name].append(value)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table({name: pa.array(out[name], kind) for name, kind in zip(out, kinds, strict=True)})

    sets = saved(packed.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(order, "id long, n long, grams binary, freqs binary, prefix array<long>"), "sets")

    first = saved(_join_units(_first_wave(sets, block, unit_bytes), percent), "links")
    labels = saved(components(first), "labels")
    second = saved(_second_wave(sets, labels, percent, block, unit_bytes, few_labels), "links")
    links = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second)
    named = saved(classes.join(components(links).withColumnRenamed("node", "print"), "print", "left").select("print", "rep", F.coalesce("component", "print").alias("c")), "named")
    smallest = named.groupBy("c").agg(F.min("rep").alias("component"))
    groups = saved(named.join(smallest, "c").select("print", "c", "component"), "groups")
    return screened.select("id", "text_hash", "n", "print").join(groups, "print", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"), "text_hash", F.col("c").alias("group")
    )
