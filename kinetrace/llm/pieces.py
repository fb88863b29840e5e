"""Exact merge-type subword encoding by backtracking, and decoding.

The encoder never runs the merge loop over a text. It walks from left to right
over the longest vocabulary matches that an Aho-Corasick automaton finds (run
over the reversed text, so that each position gets the longest piece that
*starts* there). A piece may follow another only if merging the two pieces'
joined text again yields just these two; such answers are remembered. If no
piece fits at a position, the position is marked in a bitfield of failed
positions and the walk goes back to a shorter piece. The sequence found is the
one that the merge loop yields.

Where no piece of the vocabulary holds two characters side by side, no merge
can join them; texts fall into chunks at such borders, and the results of short
chunks are remembered in a bounded table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.textcore import bounded, slices, trimmed, utf8

MARK = "▁"
#: Chunks up to this length are remembered, in a younger and an older table of so many entries at most: when
#: the younger is full it becomes the older, and what is asked for again moves to a table of frequent ones,
#: as far as that has room, or back to the younger. Remembered pairs.
MEMO_CHARS, MEMO_ENTRIES, FREQUENT, PAIR_ENTRIES = 48, 70_000, 60_000, 80_000
#: Bytes of text whose ids are held at once.
BATCH_BYTES = 1 << 20


class PieceTokenizer:
    """Encodes and decodes as a merge-type model with byte fallback does.

    >>> PieceTokenizer(model_bytes).encode("some text")   # doctest: +SKIP
    [777, 1426]
    """

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        normal = spec.normalizer_spec
        if spec.trainer_spec.model_type != proto.TrainerSpec.BPE or not spec.trainer_spec.byte_fallback:
            raise ValueError("a merge-type model with byte fallback is needed")
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("only models that leave characters and spaces as they are")
        self.prefix = MARK if normal.add_dummy_prefix else ""
        kinds = proto.ModelProto.SentencePiece
        self.surface: list[str | None] = []
        self.byte_of: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id = [0] * 256
        for i, p in enumerate(spec.pieces):
            self.surface.append(p.piece.replace(MARK, " "))
            if p.type == kinds.BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_id[value], self.byte_of[i] = i, value
            elif p.type == kinds.UNKNOWN:
                self.surface[i] = spec.trainer_spec.unk_surface
            elif p.type == kinds.CONTROL:
                self.surface[i] = ""
            elif p.type == kinds.NORMAL:
                self.ids[p.piece], self.score[p.piece] = i, p.score
            else:
                raise ValueError(f"pieces of type {p.type} are not handled")
        # A piece that its own merges do not yield never appears in a result.
        usable = [p for p in self.ids if len(p) == 1 or self.merge(p) == [p]]
        self.matcher = ahocorasick.Automaton()
        for p in usable:
            self.matcher.add_word(p[::-1], p)
        self.matcher.make_automaton()
        known = set(usable)
        self.shorter: dict[str, str | None] = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in known), p[0] if len(p) > 1 else None) for p in usable}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.old_pairs: dict[tuple[str, str], bool] = {}
        self.known = {p: (str(i), self.surface[i]) for p, i in self.ids.items()}
        self.frequent: dict[str, tuple[int, str, str | None]] = {}
        self.young: dict[str, tuple[int, str, str | None]] = {}
        self.old: dict[str, tuple[int, str, str | None]] = {}
        self.chunks = self._boundaries()

    def _boundaries(self) -> re.Pattern:
        """A pattern of chunks whose borders no piece crosses, so that no merge does.

        Chunks end before a word mark; between a letter and an ASCII mark, where
        no piece holds the two side by side; and around line ends, if no piece
        holds one.
        """
        beside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(b[1] == MARK != b[0] for b in beside):
            return re.compile("(?s).+")
        letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
        after = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and not any(x + chr(c) in beside for x in letters)]
        own = "" if any("\n" in p for p in self.ids) else "\n"
        line = f"{own}+|" if own else ""
        if not after:
            return re.compile(f"{line}{MARK}*[^{MARK}{own}]+|{MARK}+")
        marks, alphabet = re.escape("".join(after)), "".join(letters)
        return re.compile(f"{line}{MARK}*[^{MARK}{own}{marks}]*[{alphabet}](?=[{marks}])|{MARK}*[^{MARK}{own}]+|{MARK}+")

    def merge(self, text: str) -> list[str]:
        """What the merge loop makes of a short text: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, a: str, b: str) -> bool:
        """Whether b may follow a: merging both again yields the two."""
        known = self.pairs.get((a, b))
        if known is None:
            known = self.old_pairs.get((a, b))
            if known is None:
                known = self.stay_apart(a, b)
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs, self.old_pairs = {}, self.pairs
            self.pairs[a, b] = known
        return known

    def stay_apart(self, a: str, b: str) -> bool:
        """Whether merging the joined text of two pieces yields the two: given up at the first merge over their border."""
        parts, border, score = list(a + b), len(a), self.score
        found = [score.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
        while len(parts) > 2:
            best, at = None, -1
            for i, v in enumerate(found):
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if at < 0 or at + 1 == border:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = score.get(parts[at - 1] + parts[at])
            if at < len(found):
                found[at] = score.get(parts[at] + parts[at + 1])
            if at < border:
                border -= 1
        return border == 1 and found[0] is None

    def walk(self, chunk: str) -> list[str]:
        """The pieces of one chunk, by backtracking."""
        n = len(chunk)
        longest: list[str] = list(chunk)  # a character that no piece holds stands for itself
        seen = -1
        for end, piece in self.matcher.iter(chunk[::-1]):
            if end != seen:  # the first match at an end is the longest
                longest[n - 1 - end] = piece
                seen = end
        failed: bytearray | None = None  # a bit for each position from which nothing fits
        pairs, out, before = self.pairs, [], None
        at, piece = 0, longest[0]
        while at < n:
            end = at + len(piece)
            if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                if before is None:
                    good = True
                elif (good := pairs.get((before, piece))) is None:
                    good = self.fits(before, piece)
                    pairs = self.pairs
                if good:
                    out.append(piece)
                    before, at = piece, end
                    if at < n:
                        piece = longest[at]
                    continue
            less = self.shorter.get(piece)
            if less is not None:
                piece = less
                continue
            if failed is None:
                failed = bytearray((n >> 3) + 1)
            failed[at >> 3] |= 1 << (at & 7)
            piece = out.pop()
            before = out[-1] if out else None
            at -= len(piece)
        return out

    def chunk_ids(self, chunk: str) -> list[int]:
        out: list[int] = []
        for piece in self.walk(chunk):
            i = self.ids.get(piece)
            if i is None:
                out.extend(self.byte_id[b] for b in piece.encode())
            else:
                out.append(i)
        return out

    def chunked(self, text: str) -> list[str]:
        return self.chunks.findall(self.prefix + text.replace(" ", MARK)) if text else []

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; none for null or the empty text."""
        return [i for c in self.chunked(text or "") for i in self.chunk_ids(c)]

    def _joined(self, ids: list[int]) -> str:
        parts, raw = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            parts.append(self.surface[i])
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts in front goes."""
        text = self._joined(ids)
        return text[1:] if self.prefix and text.startswith(" ") and ids[0] not in self.byte_of else text

    def chunk(self, chunk: str) -> tuple[int, str, str | None]:
        """Number of ids, ids joined by commas, and decoded text of a chunk; None if that is the chunk with spaces for marks."""
        known = self.young.get(chunk)
        if known is not None:
            return known
        known = self.old.get(chunk)
        if known is not None and len(self.frequent) < FREQUENT:
            self.frequent[chunk] = known
            return known
        if known is None:
            try:
                ids, surfaces = zip(*[self.known[p] for p in self.walk(chunk)], strict=True)
                decoded = "".join(surfaces)
            except KeyError:  # characters that become bytes
                numbers = self.chunk_ids(chunk)
                ids, decoded = [str(i) for i in numbers], self._joined(numbers)
            known = len(ids), ",".join(ids), None if decoded == chunk.replace(MARK, " ") else decoded
        if len(chunk) <= MEMO_CHARS:
            if len(self.young) >= MEMO_ENTRIES:
                self.young, self.old = {}, self.young
            self.young[chunk] = known
        return known

    def forget(self) -> None:
        """Empties the tables of chunks but for the frequent ones, so that an idle worker holds little."""
        self.young, self.old = {}, {}

    def summary(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, and decoded text of a whole text."""
        chunks = self.chunked(text)
        if not chunks:
            return 0, "", ""
        frequent, chunk = self.frequent, self.chunk
        counts, ids, decoded = zip(*[frequent.get(c) or chunk(c) for c in chunks], strict=True)
        if any(decoded) or "" in decoded:
            whole = "".join([c.replace(MARK, " ") if d is None else d for c, d in zip(chunks, decoded, strict=True)])
        else:
            whole = "".join(chunks).replace(MARK, " ")
        return sum(counts), ",".join(ids), whole[1:] if self.prefix and whole.startswith(" ") else whole


_loaded: dict[str, PieceTokenizer] = {}


def tokenizer(model: bytes) -> PieceTokenizer:
    """One tokenizer per model and process, so that remembered chunks outlive a task."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = PieceTokenizer(model)
    return _loaded[key]


def encode_texts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Encodes and decodes each whole text in a narrow pass.

    Returns ``id_col``, ``n_tokens`` and, without ``digests``, ``ids``
    (array<int>) and ``decoded``; with ``digests``, ``ids_sha256`` of the
    decimal ids joined by commas and ``decoded_sha256`` of the decoded text in
    UTF-8. A null text counts as empty: no ids, empty decoded text. Null ids
    and repeated rows pass through, one row out for each row in; other columns
    are not read.
    """
    bounded(df.sparkSession)
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    id_type = df.schema[id_col].dataType.simpleString()
    kind = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    names = [id_col, "n_tokens", *(x.split()[0] for x in kind.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(model.value)
        for whole in batches:
            for i, j in slices(utf8(whole.column(1))[1], BATCH_BYTES):
                counts, ids, decoded = zip(*[t.summary(v or "") for v in whole.column(1).slice(i, j - i).to_pylist()], strict=True)
                if digests:
                    pair = [pa.array([hashlib.sha256(x.encode()).hexdigest() for x in column], pa.string()) for column in (ids, decoded)]
                else:
                    flat = np.array(",".join(x for x in ids if x).split(","), np.int32) if any(ids) else np.zeros(0, np.int32)
                    pair = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(i, j - i), pa.array(counts, pa.int64()), *pair], ["id", *names[1:]])
        t.forget()

    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(trimmed(run), f"id {id_type}, n_tokens bigint, {kind}").toDF(*names)
