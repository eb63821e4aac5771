"""Bounded-space online packing of tokenised documents into fixed windows.

Each task reads its documents once, tokenises them and keeps at most
``open_windows`` windows: a piece goes where it fits best; when it fits
nowhere a new window is opened, or, with all of them open, the fullest is
closed: its gap, if worth a cut, is filled with the head of the piece.  At
the end of a partition the open windows are poured together, which leaves
less than one window; these leftovers (a few kB each) meet in groups of
``merge_partitions`` partitions and are merged the same way.

Tokens of a document are its ids followed by the id 0; pieces of a document
cover every id exactly once.  Only piece descriptions are written between
the two steps, never texts, and a sequence id is fixed by the partition
and a counter, so a task that runs again makes the same rows.

Defined results: a null or empty text is the single id 0; repeated and
null ids are packed like any other row; an empty table gives no sequences.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from casaframe.llm.common import written

WINDOW = 1024
OPEN_WINDOWS = 64        # open windows per partition
MIN_CUT = 8              # a gap of fewer tokens is padded rather than filled by a cut
MERGE_PARTITIONS = 64    # partitions whose leftovers are merged together
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """Ids of texts by a byte-level BPE file of the ``tokenizers`` library.

    Where the file is plain byte-level BPE whose merges stand in the order of
    their ids, the ids follow from the ranks of its byte strings alone, and a
    rank-based encoder over the same file gives them several times faster;
    any other file, texts that spell out one of its special tokens and texts
    with runs of white space too long for its pattern engine go through the
    library itself.
    """

    def __init__(self, path: str):
        self.path, self.slow, self.fast = path, None, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = byte_ranks(spec, set(self.special))
        if ranks:
            import public_tokenizers
            import tiktoken
            self.fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if self.fast and not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text)
            except ValueError:  # its pattern engine gives up on about a million spaces in a row
                pass
        if not self.slow:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def byte_ranks(spec: dict, special: set[str]) -> dict[bytes, int] | None:
    """Byte string -> id of a tokenizer file, if ranks alone decide its merges, else None."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if (spec.get("normalizer") or model.get("type", "BPE") != "BPE" or model.get("dropout")
            or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
            or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space")):
        return None
    # byte-level files write a printable byte as itself, the others from U+0100 on
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    if any(c not in byte_of for t in model["vocab"] if t not in special for c in t):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items()
             if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [ranks.get(bytes(byte_of[c] for c in a + b)) for a, b in pairs]
    if None in made or made != sorted(made) or len(made) != len(ranks) - 256:
        return None
    return ranks


class Packer:
    """The open windows of one partition; ``done`` collects closed ones."""

    def __init__(self, window: int, open_windows: int, min_cut: int):
        self.window, self.limit, self.min_cut = window, open_windows, min_cut
        self.fill: list[int] = []
        self.pieces: list[list] = []   # per window: (document, start, ids)
        self.done: list[list] = []

    def _close(self, k: int) -> None:
        self.done.append(self.pieces.pop(k))
        self.fill.pop(k)

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        at, n, w = 0, len(ids), self.window
        while n - at >= w:  # whole windows need no search
            self.done.append([(doc, at, ids[at:at + w])])
            at += w
        while at < n:
            left = n - at
            best = -1
            for k, f in enumerate(self.fill):
                if f + left <= w and (best < 0 or f > self.fill[best]):
                    best = k
            if best < 0 and len(self.fill) >= self.limit:
                k = self.fill.index(max(self.fill))
                gap = w - self.fill[k]
                if gap >= self.min_cut:
                    self.pieces[k].append((doc, at, ids[at:at + gap]))
                    at += gap
                self._close(k)
                continue
            if best < 0:
                self.fill.append(0)
                self.pieces.append([])
                best = len(self.fill) - 1
            self.pieces[best].append((doc, at, ids[at:]))
            self.fill[best] += left
            at = n
            if self.fill[best] == w:
                self._close(best)

    def pour(self) -> list:
        """Close all windows by pouring them together; the pieces of the last, not full one."""
        order = sorted(range(len(self.fill)), key=lambda k: -self.fill[k])
        full, rest = poured([p for k in order for p in self.pieces[k]], self.window)
        self.done += full
        self.fill, self.pieces = [], []
        return rest


def poured(pieces: list, window: int) -> tuple[list[list], list]:
    """Fill windows with the pieces in turn: (full windows, pieces of the last one)."""
    full, now, fill = [], [], 0
    for doc, start, ids in pieces:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, window - fill)
            now.append((doc, start + at, ids[at:at + take]))
            at, fill = at + take, fill + take
            if fill == window:
                full.append(now)
                now, fill = [], 0
    return full, now


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
           "sequence_length")
def _rows(windows: list[list], first_id: int, ids: bool) -> dict[str, list]:
    out: dict[str, list] = {c: [] for c in (*COLUMNS, "ids")}
    for k, window in enumerate(windows):
        at, length = 0, sum(len(p[2]) for p in window)
        for (doc_id, tokens), start, part in window:
            raw = part.astype("<u4").tobytes()
            for c, v in zip((*COLUMNS, "ids"), (
                    doc_id, start, len(part), zlib.crc32(raw), tokens, first_id + k, at, length,
                    raw if ids else None)):
                out[c].append(v)
            at += len(part)
    return out


def pack(docs: DataFrame, *, path: str | None = None, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, min_cut: int = MIN_CUT,
         merge_partitions: int = MERGE_PARTITIONS, with_ids: bool = True) -> DataFrame:
    """One row per piece; with ``with_ids`` also its ids (little-endian unsigned 32 bit).

    ``sequence_length`` counts the tokens of the sequence; a sequence is full
    but for closing gaps under ``min_cut`` and the last of a merge group,
    which is cut into lengths that are powers of two.
    """
    path = path or tokenizer_path()
    rest = StructType.fromDDL("start long, length long, ids_crc32 long, doc_tokens long, "
                              "sequence_id long, offset long, sequence_length long, ids binary, "
                              "merge_group long")
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *rest.fields])
    arrow = to_arrow_schema(schema)

    def frame(rows: dict, group: int | None = None) -> pa.RecordBatch:
        rows["merge_group"] = [group] * len(rows["doc_id"])
        return pa.RecordBatch.from_pydict(rows, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, encoder = Packer(window, open_windows, min_cut), Encoder(path)
        next_id = part << 32
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(),
                                 batch.column("text").to_pylist()):
                ids = np.append(encoder.ids(text), np.uint32(0))
                packer.add((key, len(ids)), ids)
                if len(packer.done) >= 4096:
                    yield frame(_rows(packer.done, next_id, with_ids))
                    next_id += len(packer.done)
                    packer.done = []
        rest = packer.pour()
        yield frame(_rows(packer.done, next_id, with_ids))
        if rest:  # goes on with its ids to the merge of its group of partitions
            yield frame(_rows([rest], part, True), part // merge_partitions)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pydict()
        group = rows["merge_group"][0]
        pieces = [((d, t), s, np.frombuffer(raw, dtype="<u4")) for d, t, s, raw in
                  zip(rows["doc_id"], rows["doc_tokens"], rows["start"], rows["ids"])]
        full, rest = poured(pieces, window)
        while rest:
            left = sum(len(p[2]) for p in rest)
            head, rest = poured(rest, 1 << (left.bit_length() - 1))
            full += head
        return pa.Table.from_batches([frame(_rows(full, (1 << 62) + (group << 20), with_ids))])

    docs = docs.select("doc_id", "text")
    first = written(docs.mapInArrow(run, schema), "packing")
    last = (first.where("merge_group IS NOT NULL").groupBy("merge_group")
            .applyInArrow(merge, schema))
    out = first.where("merge_group IS NULL").unionByName(last).drop("merge_group")
    return out if with_ids else out.drop("ids")
