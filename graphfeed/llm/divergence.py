"""How the sources of a language differ in their use of common terms, counted by a transducer.

Terms are runs of letters. Each language keeps the terms in at least ``LEAST_DOCS`` of its
documents, and numbers them in the order of their UTF-8 bytes (ordinals). The kept terms are
counted once more, source by source, by streaming the texts through a minimal acyclic
transducer: an automaton without equal states, built from the sorted terms, whose outputs along
the path of a term add up to the term's place among them.

* Texts are packed in blocks (see ``blocks``). Each block tells its distinct terms; Spark adds
  them up, keeps and numbers; a block gets back the kept terms it has, with their ordinals in the
  whole vocabulary, and builds its transducer from them. So a transducer is as large as a block
  needs, and the vocabulary is nowhere whole.
* All words of a slice of text walk through the transducer side by side, a byte at a time.
* From then on terms are ordinals: they join, chunk and break ties. Strings return at the end.

Shares are whole numbers: ``1 + floor(SCALE * (n + PRIOR) / (N + PRIOR * V))``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.blocks import Block, blocks_of, runs
from graphfeed.operators.skew import number_within

LEAST_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP = 50
BLOCK_BYTES = 32_000_000
SLICE = 1 << 22  # bytes of texts that walk together
CHUNK = 4096  # terms whose shares are compared together
SOURCES = 256  # sources that are compared with all others together

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[97:123] = _IN_TERM[128:] = True
_TERM = re.compile(rb"[a-z\x80-\xff]+")


class Transducer:
    """Minimal acyclic transducer from sorted distinct byte strings to their places."""

    def __init__(self, terms: list[bytes]) -> None:
        states: dict[tuple, int] = {}  # states by what they accept; children come first
        path: list[list] = [[False, []]]  # the states along the last term, open for more arcs
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                state = states.setdefault((final, tuple(arcs)), len(states))
                path[-1][1].append((last[len(path) - 1], state))

        for term in terms:
            same, most = 0, min(len(last), len(term))
            while same < most and last[same] == term[same]:
                same += 1
            close(same)
            path += [[False, []] for _ in range(len(term) - same)]
            path[-1][0] = True
            last = term
        close(0)
        self.root = states.setdefault((path[0][0], tuple(path[0][1])), len(states))

        below = np.zeros(len(states), np.int64)  # terms from a state on
        self.final = np.zeros(len(states), bool)
        # arcs by state and byte; per state and 64 bytes a bit set and the first arc's place
        self.bits = np.zeros(4 * len(states), np.uint64)
        self.first = np.zeros(4 * len(states), np.int32)
        targets, outputs = [], []
        for (final, arcs), state in states.items():
            self.final[state] = final
            passed, word = int(final), -1
            for byte, target in arcs:
                if byte >> 6 != word:
                    word = byte >> 6
                    self.first[4 * state + word] = len(targets)
                self.bits[4 * state + word] |= np.uint64(1 << (byte & 63))
                targets.append(target)
                outputs.append(passed)
                passed += int(below[target])
            below[state] = passed
        self.targets, self.outputs = np.array(targets, np.int32), np.array(outputs, np.int64)

    def places(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The place of the term at each start, -1 where the bytes are none of the terms."""
        state = np.full(len(starts), self.root, np.int64)
        place = np.zeros(len(starts), np.int64)
        found = np.full(len(starts), -1, np.int64)
        live, at = np.arange(len(starts)), 0
        while len(live):
            byte = data[starts[live] + at]
            cell = 4 * state[live] + (byte >> 6)
            bits, bit = self.bits[cell], byte.astype(np.uint64) & np.uint64(63)
            on = (bits >> bit & np.uint64(1)).astype(bool)
            live, cell, bits, bit = live[on], cell[on], bits[on], bit[on]
            arc = self.first[cell] + np.bitwise_count(bits & ((np.uint64(1) << bit) - np.uint64(1)))
            state[live] = self.targets[arc]
            place[live] += self.outputs[arc]
            at += 1
            done = sizes[live] == at
            ended = live[done]
            ended = ended[self.final[state[ended]]]
            found[ended] = place[ended]
            live = live[~done]
        return found


def _terms_of(blocks: DataFrame) -> DataFrame:
    """(block, lang, term, n_docs): the distinct terms of each block."""
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("term", pa.string()),
                        ("n_docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, counts = Block(row), {}
                text = block.data.tobytes().lower()
                langs = block.rest["lang"].to_pylist()
                for lang, a, b in zip(langs, block.starts.tolist(), block.ends.tolist(), strict=True):
                    counts.setdefault(lang, Counter()).update(set(_TERM.findall(text, a, b)))
                for lang, own in counts.items():
                    terms = pa.array(list(own), pa.binary()).cast(pa.string())
                    whole = pa.table([pa.array([row["block"]] * len(own), pa.int64()),
                                      pa.array([lang] * len(own), pa.string()), terms,
                                      pa.array(list(own.values()), pa.int64())], schema=schema)
                    yield from whole.to_batches(max_chunksize=100_000)

    return blocks.mapInArrow(run, "block long, lang string, term string, n_docs long")


def _recounted(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, source, ordinal, n): how often each block has its known terms (block, lang, term, ordinal)."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()),
                        ("n", pa.int64())])

    def run(_: tuple, row: pa.Table, known: pa.Table) -> pa.Table:
        block = Block(row.to_pylist()[0])
        pairs = list(zip(block.rest["lang"].to_pylist(), block.rest["source"].to_pylist(), strict=True))
        numbers = {pair: i for i, pair in enumerate(dict.fromkeys(pairs))}
        names, group = list(numbers), np.array([numbers[p] for p in pairs])
        known = known.sort_by([("lang", "ascending"), ("ordinal", "ascending")])
        out = []
        for lang in dict.fromkeys(known["lang"].to_pylist()):
            own = known.filter(pc.equal(known["lang"], lang))
            ordinals = own["ordinal"].to_numpy()
            transducer = Transducer([t.encode() for t in own["term"].to_pylist()])
            keys, sums = [], []
            texts = np.flatnonzero([p[0] == lang for p in pairs])
            for some in _slices(texts, block.ends - block.starts):
                sizes = (block.ends - block.starts)[some]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                data = _LOWER[np.concatenate([block.data[block.starts[i]:block.ends[i]] for i in some])]
                starts, lengths = runs(_IN_TERM[data], bounds)
                places = transducer.places(data, starts, lengths)
                groups = np.repeat(group[some], np.diff(np.searchsorted(starts, bounds)))
                hit = places >= 0
                key, n = np.unique(groups[hit] * len(ordinals) + places[hit], return_counts=True)
                keys.append(key)
                sums.append(n)
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(back, np.concatenate(sums), len(key)).astype(np.int64)
            sources = pa.array([s for _, s in names], pa.string())
            out.append(pa.table([
                pa.array([lang] * len(key), pa.string()), sources.take(pa.array(key // len(ordinals))),
                pa.array(ordinals[key % len(ordinals)]), pa.array(n)], schema=schema))
        return pa.concat_tables([schema.empty_table(), *out])

    return (blocks.groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(run, "lang string, source string, ordinal long, n long"))


def _slices(texts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """``texts`` in runs of about ``SLICE`` bytes."""
    piece = np.cumsum(sizes[texts]) // SLICE
    yield from np.split(texts, np.flatnonzero(np.diff(piece)) + 1)


def _share(n: str, total: str, kept: str) -> Column:
    """Exact at any size: decimals of 38 digits, divided to a whole number."""
    return F.expr(f"1 + (cast({n} + {PRIOR} as decimal(28, 0)) * {SCALE}) div "
                  f"(cast({total} as decimal(28, 0)) + {PRIOR} * {kept})")


def _pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): sums of the differences of the shares of all ordered pairs of sources.

    ``shares`` has (lang, number, ordinal, p) where a term occurs, ``groups`` (lang, number,
    n_sources, kept, base) with the share of a term that does not. Terms are compared in chunks,
    and ``SOURCES`` sources at once, so no task holds all terms or all pairs.
    """
    parts = F.sequence(F.lit(0).cast("long"), F.expr(f"(n_sources - 1) div {SOURCES}"))
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(kept - 1, 0) div {CHUNK}"))
    marks = groups.select("lang", F.explode(chunks).alias("chunk"), "number", "n_sources",
                          F.lit(None).cast("long").alias("ordinal"), F.col("base").alias("p"), "kept")
    rows = marks.unionByName(
        shares.select("lang", F.expr(f"ordinal div {CHUNK}").alias("chunk"), "number", "n_sources",
                      "ordinal", "p", "kept")).withColumn("part", F.explode(parts)).drop("n_sources")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang, chunk, part = (k.as_py() for k in key)
        first = chunk * CHUNK
        width = min(CHUNK, rows["kept"][0].as_py() - first)
        mark = rows["ordinal"].is_null().to_numpy()
        number, p = rows["number"].to_numpy(), rows["p"].to_numpy()
        base = np.zeros(int(mark.sum()), np.int64)
        base[number[mark]] = p[mark]
        order = np.argsort(ordinal := rows["ordinal"].fill_null(-1).to_numpy(), kind="stable")
        ordinal, number, p = ordinal[order], number[order], p[order]
        mine = np.arange(part * SOURCES, min((part + 1) * SOURCES, len(base)))
        sums = np.zeros((len(mine), len(base)), np.int64)
        # a few terms at once: all sources, one column per term
        step = max(1, (1 << 20) // max(1, len(base)))
        for low in range(first, first + width, step):
            n = min(step, first + width - low)
            some = slice(*np.searchsorted(ordinal, [low, low + n]))
            table = np.repeat(base[:, None], n, 1)
            table[number[some], ordinal[some] - low] = p[some]
            for i, a in enumerate(mine):
                sums[i] += np.abs(table - table[a]).sum(1)
        a, b = np.repeat(mine, len(base)), np.tile(np.arange(len(base)), len(mine))
        other = a != b
        return pa.table({"lang": pa.array([lang] * int(other.sum()), pa.string()), "a": a[other],
                         "b": b[other], "value": sums.ravel()[other]})

    return rows.groupBy("lang", "chunk", "part").applyInArrow(
        run, "lang string, a long, b long, value long"
    ).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, text: Column, lang: Column, source: Column, least_docs: int = LEAST_DOCS,
            top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank) for every occurring pair of language and source.

    Part ``pair``: every other source of the language, valued by the sum of the differences of all
    kept terms' shares. Part ``term``: the ``top`` terms that the source uses more than its language.
    Null texts, languages and sources count as empty strings; each row is a document, repeated ones
    too. Without kept terms all pairs have value 0. An empty table gives no rows.
    """
    def string(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(""))

    blocks = blocks_of(docs, text, {"lang": string(lang), "source": string(source)}, "audit-blocks",
                       block_bytes)
    terms = stored(_terms_of(blocks), "audit-terms")
    kept = terms.groupBy("lang", "term").agg(F.sum("n_docs").alias("n")).filter(F.col("n") >= least_docs)
    kept = stored(number_within(kept.select("lang", "term"), ["lang"], [F.col("term")]).select(
        "lang", "term", (F.col("position") - 1).alias("ordinal")), "audit-kept")
    known = terms.select("block", "lang", "term").join(kept, ["lang", "term"])
    counts = stored(_recounted(blocks, known).groupBy("lang", "source", "ordinal").agg(
        F.sum("n").alias("n")), "audit-counts")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(string(lang).alias("lang"), string(source).alias("source")).distinct()
    n_sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    groups = (
        number_within(groups, ["lang"], [F.col("source")], "number")
        .join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").join(n_sources, "lang")
        .withColumn("number", F.col("number") - 1)
        .fillna(0, ["total", "kept"])
        .withColumn("n", F.lit(0).cast("long"))
        # without kept terms no share is used
        .withColumn("base", F.when(F.col("kept") > 0, _share("n", "total", "kept")).otherwise(0)))
    groups = stored(groups.drop("n"), "audit-groups")
    of_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n"))
    lang_totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    q = of_lang.join(lang_totals, "lang").join(sizes, "lang").select(
        "lang", "ordinal", _share("n", "total", "kept").alias("q"))
    shares = stored(counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "number", "n_sources", "kept", "ordinal",
        _share("n", "total", "kept").alias("p")), "audit-shares")

    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ordinal")
    best = (shares.join(q, ["lang", "ordinal"]).filter("p > q")
            .select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top))
    best = best.join(kept, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    numbered = groups.select("lang", "number", "source")
    other = numbered.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    by_item = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = (_pair_sums(shares, groups)
             .join(numbered.withColumnRenamed("number", "a"), ["lang", "a"]).join(other, ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                     F.row_number().over(by_item).alias("rank")))
    return pairs.unionByName(best)
