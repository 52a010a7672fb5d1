"""Token-id shards in document order, with a minimal perfect hash from document keys to shard offsets.

A folder holds
  shards/shard-000000.ids    raw little-endian ids, then the documents' offsets and keys, then a footer
  index/index-000000.mph     a perfect hash over some keys, then each slot's shard, place and rows
  manifest/                  Parquet: shard, n_docs, n_tokens, base (ids in all shards before)
Ids are 2 bytes wide if the vocabulary fits, else 4.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from tidemark.llm.chunks import IdMemory, encode_flat, gathered, no_collection
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.staging import column, id_and_text, pieces, shuffle_width, staged, text_column

#: Fixed values of the format: the mark at a shard's end, and the footer's numbers (documents, ids, null keys, id width, mark).
MARK = 0x31534449
_FOOTER = 5 * 8
#: Stretches and pieces remembered by a worker that writes shards, which runs beside no other Python stage.
MOST, MOST_PIECES = 300_000, 700_000
#: The normaliser that lower-cases ASCII letters and does nothing else to them.
_LOWER_CASING = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
#: Each slot of the index: shard, place in it, and how many documents have the key.
_COLUMNS = ("<i4", "<i8", "<i8")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _write(path: str, parts: Iterator[bytes]) -> None:
    """Write a file whole: under another name first, so that a lost or doubled task leaves no half file."""
    store, name = _store(path)
    store.create_dir(os.path.dirname(name), recursive=True)
    draft = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, name)


def _read(path: str, start: int = 0, size: int | None = None) -> bytes:
    store, name = _store(path)
    with store.open_input_file(name) as file:
        return file.read_at(file.size() - start if size is None else size, start)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shards/shard-{shard:06d}.ids"


def index_path(folder: str, part: int) -> str:
    return f"{folder}/index/index-{part:06d}.mph"


class TextEncoder:
    """Texts to ids. The tokenizer drops white space, so a text is cut at plain spaces and line breaks.

    A stretch that ends in a letter and then full stops or commas is cut there too, as the tokenizer never joins a letter and a
    mark. Arrow tells the distinct stretches of a batch; each new piece is encoded once by the library, and the texts' ids are
    gathered from one array. Pieces of ASCII letters only, which normalising merely lower-cases, go to the same model without the
    normaliser and the splitting pattern.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.plain = None
        if json.loads(self.tokenizer.to_str())["normalizer"] == _LOWER_CASING:
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.parts = IdMemory(self._encode_parts, MOST_PIECES, self.kind)
        self.stretches = IdMemory(self._encode_stretches, MOST, self.kind)

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.plain:
            return encode_flat(self.tokenizer, parts.to_pylist(), self.kind)
        letters = pc.ascii_is_alpha(parts)
        own = letters.to_numpy(zero_copy_only=False)
        plain, plain_lengths = encode_flat(self.plain, pc.ascii_lower(parts.filter(letters)).to_pylist(), self.kind, whole_words=True)
        other, other_lengths = encode_flat(self.tokenizer, parts.filter(pc.invert(letters)).to_pylist(), self.kind)
        lengths, starts = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        lengths[own], lengths[~own] = plain_lengths, other_lengths
        starts[own], starts[~own] = np.cumsum(plain_lengths) - plain_lengths, len(plain) + np.cumsum(other_lengths) - other_lengths
        return gathered(np.concatenate([plain, other]), starts, lengths), lengths

    def _encode_stretches(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        core = pc.utf8_rtrim(stretches, ".,")
        last = pc.utf8_slice_codeunits(core, -1, 1 << 30)
        # Western letters only: lower-cased they are still one letter, in every table of characters.
        cut = pc.and_(pc.not_equal(core, stretches), pc.and_(pc.utf8_is_alpha(last), pc.less(last, "\u0100")))
        heads = pc.if_else(cut, core, stretches)
        own = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        marks = [whole[len(head):] for whole, head in zip(stretches.take(pa.array(own)).to_pylist(), core.take(pa.array(own)).to_pylist())]
        coded = pa.concat_arrays([heads, pa.array(marks, pa.string())]).dictionary_encode()
        starts, lengths = self.parts.find(coded.dictionary)
        piece = coded.indices.to_numpy()
        # A stretch's pieces side by side: its head, then its marks.
        order = np.argsort(np.concatenate([np.arange(len(heads)), own]), kind="stable")
        starts, lengths = starts[piece], lengths[piece]
        whole = lengths[:len(heads)].copy()
        whole[own] += lengths[len(heads):]
        return gathered(self.parts.ids, starts[order], lengths[order]), whole

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids side by side, and how many each text has."""
        with no_collection():
            split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            coded = split.flatten().dictionary_encode()
            starts, lengths = self.stretches.find(coded.dictionary)
            at = coded.indices.to_numpy()
            lengths = lengths[at]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            bounds = split.offsets.to_numpy()
            return gathered(self.stretches.ids, starts[at], lengths), np.diff(ends[bounds - bounds[0]])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as bytes."""
        ids, lengths = self.encode_array(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(lengths)[:-1])] if len(texts) else []


@lru_cache(maxsize=2)
def _text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def _shard_writer(folder: str, tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _text_encoder(tokenizer_path), TaskContext.get().partitionId()
        sizes, keys, nulls, listed = [], [], 0, []

        def payload() -> Iterator[bytes]:
            nonlocal nulls
            for batch in batches:
                for part in pieces(batch):
                    ids, first = column(part, "id"), sum(map(len, sizes))
                    nulls += ids.null_count
                    coded, size = encoder.encode_array(text_column(part))
                    coded = np.insert(coded, np.cumsum(size), end_id)
                    sizes.append(size + 1)
                    keys.append(ids.fill_null(0).to_numpy())
                    listed.append(pa.record_batch({
                        "id": ids, "shard": pa.array(np.full(len(ids), shard, np.int32)),
                        "place": pa.array(np.arange(first, first + len(ids))), "n_tokens": pa.array(sizes[-1])}))
                    yield coded.tobytes()
            own = np.concatenate([np.zeros(0, np.int64), *sizes])
            yield np.concatenate([[0], np.cumsum(own)]).astype("<i8").tobytes()
            yield np.concatenate([np.zeros(0, np.int64), *keys]).astype("<i8").tobytes()
            yield np.array([len(own), own.sum(), nulls, encoder.kind.itemsize, MARK], "<i8").tobytes()

        first = next(batches, None)
        if first is not None:
            batches = chain([first], batches)
            _write(shard_path(folder, shard), payload())
            yield from listed

    return run


def _index_writer(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        entries = pa.Table.from_batches(held)
        part = entries["part"][0].as_py()
        keys = entries["id"].to_numpy().view(np.uint64)
        hashed = PerfectHash.build(keys)
        slots, columns = hashed.slots(keys), []
        for name, kind in zip(("shard", "place", "copies"), _COLUMNS):
            values = np.zeros(len(keys), kind)
            values[slots] = entries[name].to_numpy()
            columns.append(values.tobytes())
        _write(index_path(folder, part), iter([hashed.to_bytes(), *columns]))
        yield pa.record_batch({"part": pa.array([part], pa.int32()), "width": pa.array([width], pa.int32()),
                               "n_keys": pa.array([len(keys)], pa.int64())})

    return run


def _part(parts: int):
    return F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Encode whole texts into shards in ascending id order below ``folder``, and write their index. Returns the manifest.

    How: texts are dealt by ranges of (id, hash of the text) and sorted, and each task
    encodes its range straight into one shard, so ids never move. Documents' places are staged,
    dealt by a hash of the key, and each part gets a perfect hash with 32-bit fingerprints.
    Files are written under another name and moved, so a repeated task leaves the same file.

    ``folder`` must be one that all executors reach. Null text is empty: its end id alone. Rows with one id lie side
    by side, ordered by the text's hash, under one index entry with their number. Null ids
    come first; they have no index entry and are met by ``scan_token_files``. An empty
    table has a manifest without rows.
    """
    spark = docs.sparkSession
    width = shards or shuffle_width(spark)
    dealt = (id_and_text(docs, id_col, text_col).withColumn("turn", F.xxhash64("text"))
             .repartitionByRange(width, "id", "turn").sortWithinPartitions("id", "turn"))
    places = staged(dealt.select("id", "text").mapInArrow(_shard_writer(folder, tokenizer_path, end_id), (
        "id bigint, shard int, place bigint, n_tokens bigint")), "token-places")
    # Equal keys lie side by side, maybe in two shards: the first place and the rows from there.
    keyed = places.filter("id is not null").groupBy("id").agg(
        F.min(F.struct("shard", "place")).alias("first"), F.count("*").alias("copies")).select(
        "id", "first.*", "copies", _part(width).alias("part"))
    keyed.repartitionById(width, "part").mapInArrow(_index_writer(folder, width), "part int, width int, n_keys bigint").write.parquet(
        f"{folder}/index-parts")
    sums = places.groupBy("shard").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    bases = (F.coalesce(F.sum(n).over(over), F.lit(0)).alias(name) for n, name in (("n_tokens", "base"), ("n_docs", "doc_base")))
    sums.select("*", *bases).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


@lru_cache(maxsize=2)
def _index(path: str) -> tuple[PerfectHash, list[np.ndarray]]:
    data = _read(path)
    hashed, at = PerfectHash.from_bytes(data)
    n, columns = len(hashed.fingerprints), []
    for kind in _COLUMNS:
        columns.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return hashed, columns


def _finder(folder: str, shards: np.ndarray, bases: np.ndarray):
    """Keys to the places of their documents. Documents of one key lie one after another, maybe over several shards."""

    def places(keys: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
        at = np.searchsorted(bases, numbers, side="right") - 1
        return pa.record_batch({"id": pa.array(keys), "shard": pa.array(shards[at].astype(np.int32)), "place": pa.array(numbers - bases[at])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = column(batch, "part").to_numpy()
            for own in np.unique(part):
                keys = column(batch, "id").filter(pa.array(part == own)).to_numpy()
                hashed, columns = _index(index_path(folder, int(own)))
                slots = hashed.slots(keys.view(np.uint64))
                keys, slots = keys[slots >= 0], slots[slots >= 0]
                shard, place, copies = (c[slots] for c in columns)
                numbers = bases[np.searchsorted(shards, shard)] + place
                yield places(keys, numbers)
                for key, number, n in zip(*(x[copies > 1].tolist() for x in (keys, numbers, copies))):
                    for low in range(1, n, 1 << 16):
                        more = np.arange(number + low, number + min(n, low + (1 << 16)))
                        yield places(np.full(len(more), key), more)

    return run


class Shard:
    """An open shard: its footer, offsets and keys are read once, payloads as they are asked for."""

    def __init__(self, path: str):
        store, name = _store(path)
        self.file = store.open_input_file(name)
        size = self.file.size()
        self.n, self.ids, self.nulls, width, mark = np.frombuffer(self.file.read_at(_FOOTER, size - _FOOTER), "<i8").tolist()
        if mark != MARK:
            raise ValueError(f"{path} is not a shard of token ids")
        self.kind = np.dtype(f"<u{width}")
        self.offsets = np.frombuffer(self.file.read_at(8 * (self.n + 1), width * self.ids), "<i8")
        self.keys = np.frombuffer(self.file.read_at(8 * self.n, width * self.ids + 8 * (self.n + 1)), "<i8")

    def payload(self, place: int) -> bytes:
        """One document's ids as little-endian 32-bit numbers."""
        a, b = int(self.offsets[place]), int(self.offsets[place + 1])
        raw = self.file.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize)
        return np.frombuffer(raw, self.kind).astype("<u4").tobytes()


def _rows(shard: Shard, number: int, places: list[int]) -> pa.RecordBatch:
    keys = pa.array(shard.keys[places], mask=np.array(places) < shard.nulls)
    return pa.record_batch({
        "id": keys, "shard": pa.array(np.full(len(places), number, np.int32)), "inner": pa.array(shard.offsets[places]),
        "ids": pa.array([shard.payload(p) for p in places], pa.binary())})


def _payloads(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for batch in batches:
            ids, numbers, places = (column(batch, n).to_numpy() for n in ("id", "shard", "place"))
            edges = np.unique([*range(0, len(ids), 256), *(np.flatnonzero(np.diff(numbers)) + 1), len(ids)]).astype(int)
            for low, high in zip(edges[:-1], edges[1:]):
                if numbers[low] != number:
                    number = int(numbers[low])
                    shard = Shard(shard_path(folder, number))
                # A foreign key can pass the fingerprint, but not the shard's own key.
                own = places[low:high][shard.keys[places[low:high]] == ids[low:high]]
                if len(own):
                    yield _rows(shard, number, own.tolist())

    return run


def _scanner(folder: str, null_keys_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in column(batch, "shard").to_pylist():
                shard = Shard(shard_path(folder, number))
                last = shard.nulls if null_keys_only else shard.n  # null keys come first
                for low in range(0, last, 256):
                    yield _rows(shard, number, list(range(low, min(last, low + 256))))

    return run


_FOUND = "id bigint, shard int, inner bigint, ids binary"


def _with_starts(spark: SparkSession, folder: str, found: DataFrame, name: str) -> DataFrame:
    manifest = spark.read.parquet(f"{folder}/manifest").select(F.col("shard").alias("at"), "base")
    return found.join(F.broadcast(manifest), F.col("shard") == F.col("at")).select(  # one row a shard
        F.col("id").alias(name), (F.col("base") + F.col("inner")).alias("start"), (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids")


def read_token_files(keys: DataFrame, folder: str, key_col: str = "doc_id") -> DataFrame:
    """Look keys up: (key, start, n_tokens, ids), one row for each document that has the key.

    ``start`` is the number of ids of all documents before, ``ids`` the payload as little-endian
    32-bit numbers. Keys go to their index part and then to their shard; each step takes
    constant time a key. Null keys and keys that are not there give no rows. Repeated keys are looked up once.
    """
    spark, tasks = keys.sparkSession, shuffle_width(keys.sparkSession)
    parts = spark.read.parquet(f"{folder}/index-parts")
    bases = sorted((r["doc_base"], r["shard"]) for r in spark.read.parquet(f"{folder}/manifest").select("shard", "doc_base").collect())
    width = (parts.select("width").first() or [1])[0]
    own = keys.select(F.col(key_col).cast("bigint").alias("id")).filter("id is not null").distinct().withColumn("part", _part(width))
    known = own.join(F.broadcast(parts.select("part")), "part", "left_semi")
    finder = _finder(folder, np.array([s for _, s in bases], np.int64), np.array([b for b, _ in bases], np.int64))
    places = known.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(finder, "id bigint, shard int, place bigint")
    found = places.repartition(tasks, "shard").sortWithinPartitions("shard", "place").mapInArrow(_payloads(folder), _FOUND)
    return _with_starts(spark, folder, found, key_col)


def scan_token_files(spark: SparkSession, folder: str, key_name: str = "doc_id", null_keys_only: bool = False) -> DataFrame:
    """Every document of the shards, those with null key too (or only those), with the columns of ``read_token_files``."""
    shards = spark.read.parquet(f"{folder}/manifest").select("shard").repartition(shuffle_width(spark), "shard")
    return _with_starts(spark, folder, shards.mapInArrow(_scanner(folder, null_keys_only), _FOUND), key_name)
