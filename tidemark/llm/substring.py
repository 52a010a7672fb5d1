"""Substring dedup by Rabin-Karp hashes of all fixed-length word windows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import column, id_and_text, lists, pieces, shuffle_width, text_column, utf8
from tidemark.llm.words import mix, spaced_table, window_hashes, window_rows, word_hashes, word_spans

WINDOW = 13
_BASE, _BUCKET_BASE = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
#: Pairs packed before they are handed on.
_PACK = 1 << 19
#: Documents and bytes of text of a cell, at about this many: their hashes to go are in memory together, 16 bytes a word.
CELL, CELL_BYTES = 8192, 32 << 20


def _hashed(texts: pa.Array, window: int, with_side: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray, np.ndarray]:
    """Window hashes (and independent second ones) with their start words and rows, and the rows' first words."""
    data, at = utf8(texts)
    starts, ends, first = word_spans(data, at, spaced_table())
    begin, row = window_rows(first, window)
    h = window_hashes(word_hashes(data, starts, ends), window, _BASE)[begin]
    side = window_hashes(word_hashes(data, starts, ends, 1), window, _BUCKET_BASE)[begin] if with_side else None
    return h, side, first, begin, row


def _packed(kind: int, bucket: np.ndarray, width: int, h: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket, with the hashes and ids that belong there."""
    small = bucket.astype(np.uint16 if width < 1 << 16 else np.int64)
    order = np.argsort(small, kind="stable")
    size = np.bincount(bucket, minlength=width)
    used = np.flatnonzero(size)
    ends = np.cumsum(size[used])
    return pa.record_batch({
        "kind": pa.array(np.full(len(used), kind, np.int8)), "bucket": pa.array(used, pa.int32()),
        "h": lists(h[order].view(np.int64), ends, pa.int64()), "d": lists(d[order], ends, pa.int64())})


def _collector(window: int, width: int):
    """Per batch, one entry for each distinct window (its smallest id), and what is already known to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch.filter(column(batch, "id").is_valid())):
                ids = column(part, "id").to_numpy()
                h, side, _, _, row = _hashed(text_column(part), window, with_side=True)
                if not len(h):
                    continue
                d = ids[row]
                order = np.argsort(h, kind="stable")
                hs, ds, ss = h[order], d[order], side[order]
                new = np.ones(len(hs), bool)
                new[1:] = (hs[1:] != hs[:-1]) | (ss[1:] != ss[:-1])
                runs = np.flatnonzero(new)
                least = np.minimum.reduceat(ds, runs)
                # A smaller id in the same batch: this window goes, whatever other batches hold.
                gone = ds > least[np.cumsum(new) - 1]
                gone[1:] &= new[1:] | (ds[1:] != ds[:-1])
                if gone.any():
                    yield _packed(1, (mix(ds[gone].view(np.uint64)) % np.uint64(width)).astype(np.int64), width,
                                  hs[gone], ds[gone])
                # In text order, equal ids lie side by side and compress well.
                keep, smallest = np.zeros(len(h), bool), np.empty(len(h), np.int64)
                keep[order[runs]] = True
                smallest[order[runs]] = least
                at = np.flatnonzero(keep)
                yield _packed(0, (side[at] % np.uint64(width)).astype(np.int64), width, h[at], smallest[at])

    return run


def _mixed(ids: np.ndarray) -> np.ndarray:
    """As ``_cell``, for ids in tasks."""
    x = ids.view(np.uint64)
    return x ^ (x >> np.uint64(17)) ^ (x >> np.uint64(31))


def _cell(cells: int) -> Column:
    """Documents are dealt to cells; a row without id goes by its text."""
    key = F.coalesce("id", F.xxhash64("text"))
    mixed = key.bitwiseXOR(F.shiftrightunsigned(key, 17)).bitwiseXOR(F.shiftrightunsigned(key, 31))
    return F.pmod(F.shiftrightunsigned(mixed, 1), F.lit(cells)).cast("bigint")


def _by_cell(h: np.ndarray, d: np.ndarray, cells: int) -> pa.RecordBatch:
    """One row for each cell, with the ids and hashes that belong there in the order of ids."""
    cell = ((_mixed(d) >> np.uint64(1)) % np.uint64(cells)).astype(np.int64)
    order = np.lexsort((d, cell))
    cell, d, h = cell[order], d[order], h[order]
    ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell))
    return pa.record_batch({"cell": pa.array(cell[ends - 1]), "d": lists(d, ends, pa.int64()), "gone": lists(h, ends, pa.int64())})


def _repeated(cells: int):
    """Rows come ordered by (h, d): all but a run's smallest id lose the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, least, kept, size = None, None, [], 0
        for batch in batches:
            kind, h, d = (batch.column(i).to_numpy() for i in range(3))
            given = kind == 1
            own_h, own_d = h[~given], d[~given]
            go = np.zeros(len(own_h), bool)
            if len(own_h):
                new = np.concatenate([[own_h[0] != last], own_h[1:] != own_h[:-1]])
                begin = np.where(new, np.arange(len(own_h)), -1)
                np.maximum.accumulate(begin, out=begin)
                floor = np.where(begin >= 0, own_d[np.maximum(begin, 0)], least if least is not None else 0)
                go = own_d > floor
                last, least = own_h[-1], floor[-1]
            kept.append((np.concatenate([h[given], own_h[go]]), np.concatenate([d[given], own_d[go]])))
            size += len(kept[-1][0])
            if size >= _PACK:
                yield _by_cell(*(np.concatenate(x) for x in zip(*kept)), cells)
                kept, size = [], 0
        if size:
            yield _by_cell(*(np.concatenate(x) for x in zip(*kept)), cells)

    return run


def _stripped(part: pa.RecordBatch, gone_d: np.ndarray, gone_h: np.ndarray, window: int) -> pa.RecordBatch:
    """Documents without the words in their windows to go; those are given in the order of ids."""
    texts, ids = text_column(part), column(part, "id")
    h, _, first, begin, row = _hashed(texts, window, with_side=False)
    bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
    own_ids, known = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
    low, high = np.searchsorted(gone_d, own_ids, side="left"), np.searchsorted(gone_d, own_ids, side="right")
    words, removed, kept, opens, closes = [], [], [], [], []
    for i, text in enumerate(texts.to_pylist()):
        own = text.encode().split()
        n = len(own)
        starts = ends = ()
        if known[i] and high[i] > low[i]:
            mine = slice(bounds[i], bounds[i + 1])
            hit = begin[mine][np.isin(h[mine].view(np.int64), gone_h[low[i]:high[i]])] - first[i]
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + window, -1)
            covered = np.cumsum(edge)[:n] > 0
            change = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
            starts, ends = change[::2], change[1::2]
            own = list(compress(own, ~covered))
        words.append(n)
        removed.append(n - len(own))
        kept.append(b" ".join(own).decode())
        opens.append(starts)
        closes.append(ends)
    return pa.record_batch({
        "id": ids, "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
        "span_starts": pa.array(opens, pa.list_(pa.int64())), "span_ends": pa.array(closes, pa.list_(pa.int64())),
        "kept_text": pa.array(kept, pa.string())})


def _remover(window: int):
    """Rows come ordered by cell, with the cell's hashes before its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        current, held, gone_d, gone_h = None, [], none, none
        for batch in batches:
            cells, texts = column(batch, "cell").to_numpy(), column(batch, "is_text").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((cells[1:] != cells[:-1]) | (texts[1:] != texts[:-1])) + 1).tolist(), len(cells)]
            for low, high in zip(edges[:-1], edges[1:]):
                if low == high:
                    continue
                if cells[low] != current:
                    current, held, gone_d, gone_h = cells[low], [], none, none
                part = batch.slice(low, high - low)
                if not texts[low]:
                    held.append((column(part, "d").flatten().to_numpy(), column(part, "gone").flatten().to_numpy()))
                    continue
                if held:
                    gone_d, gone_h = (np.concatenate(x) for x in zip(*held))
                    order = np.argsort(gone_d, kind="stable")
                    held, gone_d, gone_h = [], gone_d[order], gone_h[order]
                for small in pieces(part):
                    yield _stripped(small, gone_d, gone_h, window)

    return run


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove every word in a window of ``window`` words that also starts in a document with a smaller id.

    Returns (id, n_words, n_removed, span_starts, span_ends, kept_text): the
    spans are the maximal removed word intervals, kept_text is the other words
    joined by one space. Windows are judged on the input texts.

    How: each batch of texts is hashed at once and gives one entry for each
    distinct window, so a passage in very many documents costs one entry a batch.
    Entries are packed by bucket and shuffled; Spark sorts each partition by
    hash and id, and all but the smallest id lose the window. Bucket and hash come
    from independent hashes of the words' bytes, so windows are told apart by 64 bits and the
    bucket's; ``window`` is at most 512. The hashes to go are packed by cells of documents, as many as the texts'
    number and bytes ask for; each cell's hashes are sorted in front of its texts, which stream past them.

    Null text is empty; a text of fewer words than a window stays whole. A row
    with null id is returned as it is and takes nothing from others. Rows with
    one id count as one document: they don't remove each other's windows, and what
    an earlier document removes goes from all of them. Other columns are ignored.
    An empty table gives no rows.
    """
    width = shuffle_width(docs.sparkSession)
    own = id_and_text(docs, id_col, text_col)
    entries = own.mapInArrow(_collector(window, width), "kind tinyint, bucket int, h array<bigint>, d array<bigint>")
    pairs = (entries.repartitionById(width, "bucket")
             .select("kind", F.inline(F.arrays_zip("h", "d")))
             .sortWithinPartitions("h", "d"))
    size = own.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    cells = max(width, size[0] // CELL, (size[1] or 0) // CELL_BYTES)
    gone = pairs.mapInArrow(_repeated(cells), "cell bigint, d array<bigint>, gone array<bigint>")
    both = own.select(_cell(cells).alias("cell"), F.lit(True).alias("is_text"), "id", "text").unionByName(
        gone.withColumn("is_text", F.lit(False)), allowMissingColumns=True)
    dealt = both.repartition(width, "cell").sortWithinPartitions("cell", "is_text")
    return dealt.mapInArrow(_remover(window), (
        "id bigint, n_words bigint, n_removed bigint, span_starts array<bigint>, span_ends array<bigint>, "
        "kept_text string")).withColumnRenamed("id", id_col)
