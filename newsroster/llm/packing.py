"""Packing token pieces into fixed windows by Karmarkar-Karp multiway differencing.

Documents are tokenized in Arrow batches, ended by an end id and cut into consecutive pieces of at most one window.
Pieces are dealt by a hash of (document, start) into groups of about ``group_pieces``; a group is packed on its own:

* every piece starts as a partial partition of ``m`` subsets, itself and ``m - 1`` empty ones;
* the two partial partitions of largest spread (largest minus smallest subset) are merged, the largest subset of one
  with the smallest of the other, so their imbalances cancel; this repeats until one is left, ``m`` near-equal windows;
* ``m`` starts at the least possible count, ceil(tokens / window), and while windows are over capacity rises by
  ceil(excess tokens / window); a piece of a whole window fills one alone, as differencing would leave it.

Groups are bounded by ``group_pieces`` (their count comes from the number of pieces), so a long document or a hot
source only gives more pieces in more groups. ``sequence_id`` is ``group * 2^32 + window``; offsets are gapless from 0
in the order of (doc_id, start) within a window.

Defined results: a null text is empty and gives the single end id; null doc_ids are documents of their own kind (all
pieces of null ids hash alike, each piece is kept); repeated rows give repeated pieces, each packed; an empty table
gives no rows. Only the id column and the text column are read; other columns do not travel.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import stored
from .workers import worker_state

PIECES = "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long"


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True  # special strings inside a text stay ordinary text
    return tok


class _Ranks:
    """The same byte-level vocabulary as merge ranks, encoded by tiktoken; ``encode_batch`` as tokenizers has it."""

    def __init__(self, path: str, pattern: str) -> None:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        self.enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_batch(self, texts: list[str], add_special_tokens: bool = False):
        return [_Ids(ids) for ids in self.enc.encode_ordinary_batch(texts, num_threads=1)]


class _Ids:
    __slots__ = ("ids",)

    def __init__(self, ids: list[int]) -> None:
        self.ids = ids


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0,
                 key: str = "doc_id", text: str = "text", with_ids: bool = True,
                 slice_chars: int = 1 << 20, ranks: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: ids of a document plus ``end_id``, cut every ``window`` ids.

    Ids are those of the tokenizers file ``tokenizer_path`` (special strings in a text are ordinary text). With
    ``ranks`` (path of the same vocabulary as merge ranks, pre-token pattern) they are computed by tiktoken, which
    gives the same ids about four times faster; tests hold the two equal.

    Texts are encoded a slice of about ``slice_chars`` characters at a time (a longer text alone), and each slice's
    rows are sent on before the next is encoded, so a worker holds one slice's encodings. Without ``with_ids`` the
    ``ids`` column is null and only the layout columns are made.
    """

    def rows_of(keys, encodings):
        out = {"doc_id": [], "start": [], "length": [], "ids": [], "ids_crc32": [], "doc_tokens": []}
        for doc, enc in zip(keys, encodings):
            ids = np.array(enc.ids + [end_id], dtype="<u4")
            for start in range(0, len(ids), window):
                part = ids[start:start + window]
                out["doc_id"].append(None if pd.isna(doc) else int(doc))
                out["start"].append(start)
                out["length"].append(len(part))
                out["ids"].append(part.astype(np.int32) if with_ids else None)
                out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                out["doc_tokens"].append(len(ids))
        return pd.DataFrame(out).astype({"doc_id": "Int64"})

    def cut(batches):
        tok = worker_state(("pack", tokenizer_path, ranks), lambda: _Ranks(*ranks) if ranks else _tokenizer(
            tokenizer_path))
        for batch in batches:
            texts, keys = batch["__text"].fillna("").tolist(), batch["__key"].tolist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= slice_chars):
                    chars += len(texts[end])
                    end += 1
                yield rows_of(keys[at:end], tok.encode_batch(texts[at:end], add_special_tokens=False))
                at = end

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("__key"),
                       F.col(f"`{text}`").cast("string").alias("__text"))
    return rows.mapInPandas(cut, PIECES)


def differencing(sizes: np.ndarray, m: int) -> list[np.ndarray]:
    """Karmarkar-Karp into ``m`` subsets: indexes of ``sizes`` per subset, largest sum first."""
    nxt = np.full(len(sizes), -1, dtype=np.int64)
    heap = [(-int(s), i, (np.array([s], dtype=np.int64), np.array([i]), np.array([i])))
            for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tick = len(heap)
    while len(heap) > 1:
        sa, ha, ta = heapq.heappop(heap)[2]
        sb, hb, tb = heapq.heappop(heap)[2]
        if len(sa) + len(sb) <= m:
            s, h, t = np.concatenate([sa, sb]), np.concatenate([ha, hb]), np.concatenate([ta, tb])
        else:
            def pad(v, fill):
                return np.concatenate([v, np.full(m - len(v), fill, dtype=np.int64)])

            sa, ha, ta = pad(sa, 0), pad(ha, -1), pad(ta, -1)
            sb, hb, tb = pad(sb, 0)[::-1], pad(hb, -1)[::-1], pad(tb, -1)[::-1]
            both = (ha >= 0) & (hb >= 0)
            nxt[ta[both]] = hb[both]
            s, h, t = sa + sb, np.where(ha >= 0, ha, hb), np.where(hb >= 0, tb, ta)
            used = h >= 0
            s, h, t = s[used], h[used], t[used]
        order = np.argsort(-s, kind="stable")
        s, h, t = s[order], h[order], t[order]
        spread = int(s[0] - (s[-1] if len(s) == m else 0))
        heapq.heappush(heap, (-spread, tick, (s, h, t)))
        tick += 1
    if not heap:
        return []
    bins = []
    for head in heap[0][2][1]:
        members, at = [], head
        while at >= 0:
            members.append(at)
            at = nxt[at]
        bins.append(np.array(members, dtype=np.int64))
    return bins


def pack_sizes(sizes: np.ndarray, window: int) -> tuple[list[np.ndarray], int]:
    """Windows of at most ``window``.

    A piece of exactly ``window`` ids fills a window alone (differencing would leave it alone too). The others are
    differenced into the least count of windows first; while windows are over capacity, the count rises by the
    windows their excess fills at least (one or more) and differencing starts again.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    alone = np.flatnonzero(sizes >= window)
    rest = np.flatnonzero(sizes < window)
    bins: list[np.ndarray] = []
    if len(rest):
        m = max(1, math.ceil(int(sizes[rest].sum()) / window))
        while True:
            bins = [rest[b] for b in differencing(sizes[rest], m)]
            excess = sum(max(0, int(sizes[b].sum()) - window) for b in bins)
            if not excess:
                break
            m += math.ceil(excess / window)
    bins += [np.array([i]) for i in alone]
    return bins, len(bins)


def pack(pieces: DataFrame, window: int = 1024, group_pieces: int = 512) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``; all columns of ``pieces`` (ids included) are kept.

    ``pieces`` needs ``doc_id``, ``start`` and ``length``; a column named ``__group`` is replaced. Pass pieces without
    their ids when only the layout is wanted: then only those few columns are shuffled.
    """
    kept = stored(pieces.drop("__group"), "pack-pieces")
    groups = max(1, math.ceil(kept.count() / group_pieces))
    dealt = kept.withColumn("__group", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "length"], na_position="first", kind="stable")
        frame = frame.reset_index(drop=True)
        sizes = frame["length"].to_numpy(dtype=np.int64)
        bins, _ = pack_sizes(sizes, window)
        seq = np.zeros(len(frame), dtype=np.int64)
        off = np.zeros(len(frame), dtype=np.int64)
        group = int(frame["__group"].iloc[0]) << 32
        for j, members in enumerate(bins):
            members = np.sort(members)  # (doc_id, start) order inside a window
            seq[members] = group + j
            off[members] = np.concatenate([[0], np.cumsum(sizes[members])[:-1]])
        return frame.drop(columns=["__group"]).assign(sequence_id=seq, offset=off)

    schema = T.StructType([*kept.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return dealt.groupBy("__group").applyInPandas(place, schema)
