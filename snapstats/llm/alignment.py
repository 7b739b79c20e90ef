"""Cross-tokenizer alignment with corpus-wide counts of linked id pairs, counted externally over sorted runs.

Each text, behind a space, is encoded by a byte-level BPE (A) and a sentencepiece model (B).  Byte offsets where tokens
of both end cut them into groups; every A token of a group is linked with every B token of it.  The count of an id pair
is the number of documents (rows) that hold it linked.

1. A task encodes its documents and, per batch of ``BATCH_BYTES`` of text, radix-partitions the pairs by their A id into
   ``RADIX`` sorted runs of (pair, documents), in zstd blocks: a pair is counted before it moves, so an id that a third
   of all rows hold is one entry per batch and partner.
2. The runs of a radix, dealt by batch to slices of bounded size, are merged: a heap over the last keys of the cursors'
   blocks tells how far all of them may be read, and equal pairs are added up.
3. The merged runs of a radix are merged again.  As keys lie in order of their A id, its maximum is known as soon as the
   next id begins; then a second set of cursors over the same runs hands each entry its count and whether it is best.
4. What came back goes down the same way, slice to run to batch, where the documents of the batch are finished.

Both numbers of messages, batches times radix and slices times radix, grow with the text only, as ``RADIX`` is fixed; a
group of step 2 holds ``SLICE_BYTES`` and one of step 3 what the vocabularies bound.  Blocks are decompressed one at a time.

Both encoders cut at spaces behind other characters, so texts are encoded by such segments, each distinct one once for
as long as it is remembered; models whose pieces hold a space inside, or that normalise, are refused.

Null and empty texts, and those whose tokens do not give back their bytes, have no tokens: zeros and an empty hash
column.  Repeated rows are documents of their own.  A batch holds one document at least, so a very long text is a batch
of its own.  Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import spread, stage

RADIX, BATCH_BYTES, PART_CHARS, MEMO, BLOCK, SLICE_BYTES = 64, 16 << 20, 1 << 20, 250_000, 4096, 32 << 20
MANY_LINKS = 1 << 16
SEGMENT = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?|\s+")
DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BATCH = f"batch long, docs array<struct<{DOCS.replace(' ', ':').replace(',:', ', ')}>>, refs binary, runs array<struct<radix:int, run:binary>>"
RESULT = f"{DOCS}, n_best long, count_sum long"

Run = Iterable[tuple[np.ndarray, np.ndarray]]  # blocks of (keys, values), keys rising


# --- encoding ----------------------------------------------------------------------------------------


#: Fixed value: how a byte-level vocabulary cuts text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself where printable, else 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Encoders:
    """Both models, with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocab = byte_letters(), model["vocab"]
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if all(c in letters for c in t)}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if any(vocab[m] != 256 + i for i, m in enumerate(merges)):
            raise ValueError("ids must be in the order of the merges")
        ranks = {t: i for t, i in ranks.items() if i < 256 + len(merges)}
        # special tokens are left out, so their strings in a text are ordinary text
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces) or self.b.encode(" ﬁ  x ", out_type=str)[-1] != "▁":
            raise ValueError("pieces must not span words, nor the model normalise its input")
        self.space = self.b.piece_to_id("▁")  # a space alone, which the model would leave out
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [[t for t, _ in sorted(ranks.items(), key=lambda x: x[1])], bytes_b]
        self.sizes = [np.array([len(t) for t in side], np.int64) for side in self.bytes]
        # how an id is shown: followed by another of its side, or by the other side or the next group
        self.shown = [f"{i}{mark}" for side, marks in zip(self.bytes, (",|", ",;"), strict=True) for mark in marks for i in range(len(side))]

    def encode(self, segments: list[str]) -> list[list[list[int]]]:
        """Ids of both for texts that begin with a space; the second model puts that space there itself."""
        return [[self.a.encode_ordinary(s) for s in segments],
                [ids or [self.space] for ids in self.b.encode([s[1:] for s in segments], num_threads=1)]]


def distinct(owner: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (owner, key) once, sorted, with the sum of its times."""
    order = np.lexsort((key, owner))
    owner, key, times = owner[order], key[order], times[order]
    first = np.nonzero(np.r_[len(key) > 0, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])[0]
    return owner[first], key[first], np.add.reduceat(times, first) if len(first) else times


class Segments(dict):
    """Places of segments in order of first sight, with what each adds to a document."""

    def __init__(self, encoders: Encoders):
        super().__init__()
        self.encoders = encoders
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.good, self.sizes = array("b"), array("q")  # sizes: n_a, n_b, n_groups, n_links
        self.keys, self.times, self.ends, self.shown = array("q"), array("q"), array("q", [0]), []

    def learn(self, segments: Iterable[str]) -> None:
        new = [s for s in dict.fromkeys(segments) if s not in self]
        if not new:
            return
        coded, texts = self.encoders.encode(new), [s.encode("utf-8", "surrogatepass") for s in new]
        good = self._good(coded, texts)
        own, ids, end = [], [], []
        for side, size in zip(coded, self.encoders.sizes, strict=True):
            own.append(np.repeat(np.arange(len(new)), np.array([len(x) if g else 0 for x, g in zip(side, good, strict=True)], np.int64)))
            ids.append(np.fromiter(chain.from_iterable(x for x, g in zip(side, good, strict=True) if g), np.int64, len(own[-1])))
            end.append(np.cumsum(size[ids[-1]]))
        both = np.intersect1d(end[0], end[1], assume_unique=True)
        group = [np.searchsorted(both, e) for e in end]
        number = [np.bincount(g, minlength=len(both)) for g in group]
        of_group = own[0][np.searchsorted(end[0], both)]
        n_links = np.zeros(len(new), np.int64)
        np.add.at(n_links, of_group, number[0] * number[1])
        counts = [np.bincount(o, minlength=len(new)) for o in own] + [np.bincount(of_group, minlength=len(new)), n_links]
        owner, key, times = self._links(ids, number, of_group)
        self.good.frombytes(good.astype(np.int8).tobytes())
        self.sizes.frombytes(np.stack(counts, 1).astype(np.int64).tobytes())
        base = self.ends[-1]
        self.keys.frombytes(key.tobytes())
        self.times.frombytes(times.tobytes())
        self.ends.frombytes((base + np.searchsorted(owner, np.arange(1, len(new) + 1))).astype(np.int64).tobytes())
        self._show(ids, group, own, number, len(new))
        for place, segment in enumerate(new, len(self)):
            self[segment] = place

    def _good(self, coded: list[list[list[int]]], texts: list[bytes]) -> np.ndarray:
        """Which segments both sides give back."""
        good = np.ones(len(texts), bool)
        for side, parts in zip(coded, self.encoders.bytes, strict=True):
            good &= [b"".join([parts[i] for i in ids]) == text for ids, text in zip(side, texts, strict=True)]
        return good

    @staticmethod
    def _links(ids: list[np.ndarray], number: list[np.ndarray], of_group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment, pair, occurrences); groups of very many links are counted per distinct id first."""
        starts = [np.cumsum(n) - n for n in number]
        small = number[0] * number[1] <= MANY_LINKS
        a = spread(starts[0][small], number[0][small])
        right = np.repeat(number[1][small], number[0][small])
        b = spread(np.repeat(starts[1][small], number[0][small]), right)
        owners, keys = [np.repeat(of_group[small], (number[0] * number[1])[small])], [np.repeat(ids[0][a], right) << 16 | ids[1][b]]
        times = [np.ones(len(b), np.int64)]
        for g in np.nonzero(~small)[0].tolist():
            (left, m), (other, n) = (np.unique(x[s[g] : s[g] + c[g]], return_counts=True) for x, s, c in zip(ids, starts, number, strict=True))
            keys.append((left[:, None] << 16 | other[None, :]).ravel())
            times.append((m[:, None] * n[None, :]).ravel())
            owners.append(np.full(len(keys[-1]), of_group[g]))
        return distinct(*(np.concatenate(x) for x in (owners, keys, times)))

    def _show(self, ids: list[np.ndarray], group: list[np.ndarray], own: list[np.ndarray], number: list[np.ndarray], segments: int) -> None:
        """The groups of each segment as text, with a mark behind the last one too."""
        base, signs, place = 0, [], []
        for side in range(2):
            last = np.r_[group[side][1:] != group[side][:-1], np.ones(min(len(ids[side]), 1), bool)]
            size = len(self.encoders.bytes[side])
            signs.append(base + ids[side] + size * last)
            place.append(group[side] * 2 + side)
            base += 2 * size
        order = np.argsort(np.concatenate(place), kind="stable")
        shown = list(map(self.encoders.shown.__getitem__, np.concatenate(signs)[order].tolist()))
        bounds = np.r_[0, np.cumsum(sum(np.bincount(o, minlength=segments) for o in own))].tolist()
        self.shown += ["".join(shown[i:j]) for i, j in zip(bounds, bounds[1:])]


def part_of(texts: list[str | None], segments: Segments) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text the four sizes and its hash; and (text, pair, occurrences), sorted by text, for each distinct pair of one."""
    lists = [SEGMENT.findall(f" {t}") if t else [] for t in texts]
    if len(segments) > MEMO:
        segments.clear()
    segments.learn(chain.from_iterable(lists))
    number = np.array([len(x) for x in lists], np.int64)
    at = np.fromiter(map(segments.__getitem__, chain.from_iterable(lists)), np.int64, int(number.sum()))
    text = np.repeat(np.arange(len(texts)), number)
    good = np.ones(len(texts), bool)
    good[text[np.frombuffer(segments.good, np.int8)[at] == 0] if len(at) else text] = False
    at, text = at[good[text]], text[good[text]]
    sizes = np.zeros((len(texts), 4), np.int64)
    shas, shown = [""] * len(texts), segments.shown
    if not len(at):
        return sizes, shas, text, text, text
    np.add.at(sizes, text, np.frombuffer(segments.sizes, np.int64).reshape(-1, 4)[at])
    starts = np.r_[0, np.cumsum(np.bincount(text, minlength=len(texts)))]
    places = at.tolist()
    for i in np.nonzero(np.diff(starts))[0].tolist():
        joined = "".join([shown[p] for p in places[starts[i] : starts[i + 1]]])
        shas[i] = hashlib.sha256(joined[:-1].encode()).hexdigest()
    ends = np.frombuffer(segments.ends, np.int64)
    size = ends[at + 1] - ends[at]
    entry = spread(ends[at], size)
    return sizes, shas, *distinct(np.repeat(text, size), *(np.frombuffer(x, np.int64)[entry] for x in (segments.keys, segments.times)))


# --- runs --------------------------------------------------------------------------------------------


def packed(*columns: np.ndarray) -> bytes:
    """Columns of longs of one length, compressed."""
    return zstandard.compress(np.concatenate([np.array([len(columns[0])], np.int64), *[c.astype(np.int64) for c in columns]]).tobytes(), 1)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    got = np.frombuffer(zstandard.decompress(data), np.int64)
    return np.split(got[1:], columns) if len(got) > 1 else [got[1:]] * columns


class Writer:
    """Collects rising (key, value) entries into blocks; the differences of keys compress well."""

    def __init__(self):
        self.out, self.waiting, self.size = bytearray(), [], 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.waiting.append((keys, values))
        self.size += len(keys)
        if self.size >= BLOCK:
            self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        keys, values = (np.concatenate(c) for c in zip(*self.waiting, strict=True))
        while len(keys) >= max(least, 1):
            data = packed(np.diff(keys[:BLOCK], prepend=0), values[:BLOCK])
            self.out += len(data).to_bytes(4, "little") + data
            keys, values = keys[BLOCK:], values[BLOCK:]
        self.waiting, self.size = [(keys, values)], len(keys)

    def close(self) -> bytes:
        if self.size:
            self._flush(1)
        return bytes(self.out)


def blocks(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(run):
        size = int.from_bytes(run[at : at + 4], "little")
        keys, values = unpacked(run[at + 4 : at + 4 + size], 2)
        yield np.cumsum(keys), values
        at += 4 + size


class Cursor:
    """Reads a run block by block."""

    def __init__(self, run: bytes):
        self.rest = blocks(run)
        self.block = next(self.rest, None)

    def last(self) -> int:
        return int(self.block[0][-1])

    def take(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All entries up to ``limit``."""
        while self.block is not None:
            keys, values = self.block
            n = int(np.searchsorted(keys, limit, "right"))
            if n:
                yield keys[:n], values[:n]
            if n < len(keys):
                self.block = keys[n:], values[n:]
                return
            self.block = next(self.rest, None)


def merged(runs: list[bytes]) -> Run:
    """One rising sequence of distinct keys with the sum of their values."""
    cursors = [Cursor(r) for r in runs]
    heap = [(c.last(), i) for i, c in enumerate(cursors) if c.block is not None]
    heapq.heapify(heap)
    while heap:
        limit = heap[0][0]  # no cursor holds a key up to here beyond its block
        got = [b for c in cursors for b in c.take(limit)]
        while heap and heap[0][0] <= limit:
            _, i = heapq.heappop(heap)
            if cursors[i].block is not None:
                heapq.heappush(heap, (cursors[i].last(), i))
        keys, values = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        first = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0]
        yield keys[first], np.add.reduceat(values, first)


def with_best(counted: Run) -> Run:
    """Each pair's count, doubled, plus one where no partner of its A id has a higher one."""
    held = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def settled(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.nonzero(np.r_[True, np.diff(keys >> 16) != 0])[0]
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.r_[first, len(keys)]))
        return keys, counts * 2 + (counts == most)

    for keys, counts in counted:
        keys, counts = np.r_[held[0], keys], np.r_[held[1], counts]
        done = int(np.searchsorted(keys >> 16, keys[-1] >> 16))  # the last A id may go on
        if done:
            yield settled(keys[:done], counts[:done])
        held = keys[done:], counts[done:]
    if len(held[0]):
        yield settled(*held)


def handed_back(results: Run, runs: list[bytes]) -> list[bytes]:
    """For each run the results of its keys, as a run."""
    cursors, writers = [Cursor(r) for r in runs], [Writer() for _ in runs]
    for keys, values in results:
        for cursor, writer in zip(cursors, writers, strict=True):
            for own, _ in cursor.take(int(keys[-1])):
                writer.add(own, values[np.searchsorted(keys, own)])
    return [w.close() for w in writers]


# --- stages ------------------------------------------------------------------------------------------


class Batch:
    """Documents of one task whose pairs are counted together."""

    def __init__(self):
        self.docs, self.number, self.keys, self.times, self.size = [], [], [], [], 0

    def add(self, ids: list, texts: list[str | None], segments: Segments) -> None:
        sizes, shas, text, key, times = part_of(texts, segments)
        self.docs += zip(ids, *(c.tolist() for c in sizes.T), shas, strict=True)
        self.number.append(np.bincount(text, minlength=len(texts)))
        self.keys.append(key)
        self.times.append(times)
        self.size += sum(map(len, filter(None, texts)))

    def row(self, batch: int) -> dict:
        """Entries of documents refer to the batch's distinct pairs in order of radix and pair."""
        keys, place, counts = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        radix = (keys >> 16) % RADIX
        order = np.argsort(radix, kind="stable")
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        bounds, runs = np.searchsorted(radix[order], np.arange(RADIX + 1)), []
        for r in np.nonzero(np.diff(bounds))[0].tolist():
            own, writer = order[bounds[r] : bounds[r + 1]], Writer()
            writer.add(keys[own], counts[own])
            runs.append({"radix": r, "run": writer.close()})
        number = packed(np.concatenate(self.number))
        refs = len(number).to_bytes(4, "little") + number + packed(rank[place], np.concatenate(self.times))
        names = [f.split()[0] for f in DOCS.split(", ")]
        return {"batch": batch, "docs": [dict(zip(names, d, strict=True)) for d in self.docs], "refs": refs, "runs": runs}


def _encoded(path_a: str, path_b: str, schema: pa.Schema, batch_bytes: int):
    def work(batches):
        segments, batch, made = Segments(Encoders(path_a, path_b)), Batch(), 0
        first = TaskContext.get().partitionId() << 32
        for rows in batches:
            ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            ends = np.cumsum([len(t or "") for t in texts]) // PART_CHARS
            for part in np.split(np.arange(len(texts)), np.nonzero(np.diff(ends))[0] + 1):
                batch.add([ids[k] for k in part], [texts[k] for k in part], segments)
                if batch.size >= batch_bytes:
                    yield pa.RecordBatch.from_pylist([batch.row(first + made)], schema)
                    batch, made = Batch(), made + 1
        if batch.docs:
            yield pa.RecordBatch.from_pylist([batch.row(first + made)], schema)

    return work


def _joined(runs: list[bytes]) -> bytes:
    writer = Writer()
    for keys, values in merged(runs):
        writer.add(keys, values)
    return writer.close()


def _merge_slice(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"radix": frame["radix"][:1], "slice": frame["slice"][:1], "run": [_joined(list(frame["run"]))]})


def _settle(frame: pd.DataFrame) -> pd.DataFrame:
    runs = list(frame["run"])
    return frame[["radix", "slice"]].assign(result=handed_back(with_best(merged(runs)), runs))


def _hand_back(runs: pd.DataFrame, results: pd.DataFrame) -> pd.DataFrame:
    own = list(runs["run"])
    return runs[["batch", "radix"]].assign(result=handed_back(blocks(results["result"].iloc[0]), own) if own else [])


def _finished(schema: pa.Schema):
    def work(batches):
        for rows in batches:
            for docs, refs, results in zip(rows.column("docs"), rows.column("refs"), rows.column("results"), strict=True):
                docs, refs = pa.Table.from_pylist(docs.as_py()), refs.as_py()
                size = int.from_bytes(refs[:4], "little")
                (number,), (place, times) = unpacked(refs[4 : 4 + size], 1), unpacked(refs[4 + size :], 2)
                answers = sorted((r["radix"], r["result"]) for r in results.as_py() or ())
                values = [v for _, result in answers for _, v in blocks(result)]
                found = np.concatenate(values)[place] if values else place
                ends = np.cumsum(number)
                for name, each in (("n_best", (found & 1) * times), ("count_sum", (found >> 1) * times)):
                    total = np.r_[0, np.cumsum(each)]
                    docs = docs.append_column(name, pa.array(total[ends] - total[ends - number], pa.int64()))
                yield from docs.cast(schema).to_batches()

    return work


def align(docs: DataFrame, path_a: str, path_b: str, batch_bytes: int = BATCH_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    batch, result = (to_arrow_schema(StructType.fromDDL(x)) for x in (BATCH, RESULT))
    batches = stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encoded(path_a, path_b, batch, batch_bytes), BATCH), "alignment-batches")
    runs = batches.select("batch", F.explode("runs").alias("r")).select("batch", "r.radix", "r.run")
    size = runs.agg(F.coalesce(F.sum(F.octet_length("run")), F.lit(0))).first()[0]
    slices = 1 + size // (RADIX * slice_bytes)
    sliced = runs.withColumn("slice", F.pmod(F.xxhash64("batch"), F.lit(slices)).cast("int"))
    joined = stage(sliced.groupBy("radix", "slice").applyInPandas(_merge_slice, "radix int, slice int, run binary"), "alignment-merged")
    settled = stage(joined.groupBy("radix").applyInPandas(_settle, "radix int, slice int, result binary"), "alignment-settled")
    back = sliced.groupBy("radix", "slice").cogroup(settled.groupBy("radix", "slice")).applyInPandas(_hand_back, "batch long, radix int, result binary")
    answers = stage(back, "alignment-answers").groupBy("batch").agg(F.collect_list(F.struct("radix", "result")).alias("results"))
    return batches.select("batch", "docs", "refs").join(answers, "batch", "left").drop("batch").mapInArrow(_finished(result), RESULT)
