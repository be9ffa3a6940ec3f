"""SentencePiece BPE encoding with a prefix table over merge-type pieces, and its decoding.

The prefix table holds, for every prefix of a stretch of text, the last piece of that prefix's encoding. It is unique:
of the pieces that an Aho-Corasick automaton finds to end there, exactly one stays apart from the last piece of the
prefix before it when the two are merged. The ids are recovered from the end backwards.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_SPACE = "▁"
#: Entries that a Python worker remembers (stretches, seams) before it starts anew; results don't depend on it.
REMEMBERED = 1_000_000
#: Stretches longer than this are encoded each time.
LONG = 48


class PieceCodec:
    """Encoder and decoder of one SentencePiece BPE model with identity normalisation and byte fallback."""

    def __init__(self, model_file: str) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(len(self.pieces))]
        self.byte = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.control = {i for i in range(len(self.pieces)) if model.is_control(i)}
        self.unknown = next((i for i in range(len(self.pieces)) if model.is_unknown(i)), None)
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and i not in self.byte_of}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        if any(_SPACE in p.lstrip(_SPACE) for p in self.ids):
            raise ValueError("a piece spans two words; stretches can't be told apart")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        # a character that no longer piece contains never merges, so that stretches end at it
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(re.escape(c) for c in "\n\t\r|" if c not in joined)
        self.stretch = re.compile(f"[{alone}]|{_SPACE}+[^{_SPACE}{alone}]*|[^{_SPACE}{alone}]+" if alone else f"{_SPACE}+[^{_SPACE}]*|[^{_SPACE}]+")
        self.seams: dict[int, bool] = {}
        self.traces: dict[int, list[tuple[float, str, str]]] = {}
        self.known: dict[str, tuple[bytes, str]] = {}

    def merges(self, piece: int) -> list[tuple[float, str, str]]:
        """The merges that make one piece of its characters, in order: score, then first and last part before each."""
        if (known := self.traces.get(piece)) is None:
            parts, known = list(self.pieces[piece]), []
            while len(parts) > 1:
                scores = [self.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:], strict=False)]
                best = max(scores)
                if best == -np.inf:  # no merges make this piece, so that no encoding holds it
                    break
                known.append((best, parts[0], parts[-1]))
                at = scores.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known.append((-np.inf, parts[0], parts[-1]))
            self.traces[piece] = known
        return known

    def whole(self, piece: int) -> bool:
        """Whether merging a piece's characters gives that piece again."""
        return self.merges(piece)[-1][1] == self.pieces[piece]

    def seam_holds(self, left: int, right: int) -> bool:
        """Whether two adjacent pieces stay apart when their joint text is merged, best score first, leftmost first.

        Up to the seam's own merge the two sides go their own ways, so that it's enough to play their merges against
        the best that the parts on both sides of the seam offer at each moment. After no piece (``left`` is the number
        of pieces) only ``right`` itself counts.
        """
        if not self.whole(right):
            return False
        if left == len(self.pieces):
            return True
        a, b, i, j = self.merges(left), self.merges(right), 0, 0
        while True:
            across = self.score.get(a[i][2] + b[j][1])
            if across is not None and across > a[i][0] and across >= b[j][0]:
                return False
            if a[i][0] == b[j][0] == -np.inf:
                return True
            if a[i][0] >= b[j][0]:
                i += 1
            else:
                j += 1

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """For each prefix, the id and length of its last piece; the number of pieces stands for a character without one."""
        none = len(self.pieces)
        last, size, seams, done = [none] * len(text), [1] * len(text), self.seams, -1
        for end, (length, piece) in self.automaton.iter(text):  # by end, the longest first
            if end != done:
                start = end - length
                seam = (last[start] if start >= 0 else none) * (none + 1) + piece
                if (holds := seams.get(seam)) is None:
                    if len(seams) >= REMEMBERED:
                        seams.clear()
                    holds = seams[seam] = self.seam_holds(seam // (none + 1), piece)
                if holds:
                    last[end], size[end], done = piece, length, end
        return last, size

    def ids_of(self, stretch: str) -> list[int]:
        """Ids of one stretch, recovered backwards from its prefix table."""
        (last, size), end, out = self.table(stretch), len(stretch) - 1, []
        while end >= 0:
            if last[end] < len(self.pieces):
                out.append(last[end])
            else:
                out.extend(self.byte[b] for b in reversed(stretch[end].encode()))
            end -= size[end]
        return out[::-1]

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if not text:
            return b""
        known, out = self.known, []
        for stretch in self.stretch.findall(_SPACE + text.replace(" ", _SPACE)):
            if (ids := known.get(stretch)) is None:
                ids = array("i", self.ids_of(stretch)).tobytes()
                if len(stretch) <= LONG:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[stretch] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of ``ids``: bytes gathered as UTF-8, the word mark back to a space, the leading one dropped."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        if not hasattr(self, "flat"):
            kinds = np.zeros(len(self.pieces), bool)
            kinds[list(self.byte_of)] = True
            self.is_byte, self.flat = kinds, ["" if i in self.control else p.replace(_SPACE, " ") for i, p in enumerate(self.pieces)]
            if self.unknown is not None:
                self.flat[self.unknown] = " ⁇ "
        if not self.is_byte[ids].any():
            text = "".join(map(self.flat.__getitem__, ids.tolist()))
        else:
            out, held = [], bytearray()
            byte_of, flat = self.byte_of, self.flat
            for i in ids.tolist():
                if i in byte_of:
                    held.append(byte_of[i])
                else:
                    if held:
                        out.append(held.decode("utf-8", "replace"))
                        held.clear()
                    out.append(flat[i])
            if held:
                out.append(held.decode("utf-8", "replace"))
            text = "".join(out)
        return text[1:] if self.pieces[int(ids[0])].startswith(_SPACE) else text


_codecs: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """The codec of a model, built once in each Python worker."""
    if model_file not in _codecs:
        _codecs[model_file] = PieceCodec(model_file)
    return _codecs[model_file]


def encode_pieces(docs: DataFrame, model_file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Ids and decoded text of every row: the columns of ``keep``, then ids (array of int) and decoded (string).

    ``model_file`` must exist on every executor. A null or empty text has no ids and decodes to an empty text. Texts are
    encoded whole, one row at a time, whatever their length; repeated rows give repeated results; an empty table gives an
    empty result; columns that aren't kept are never read. The work is one pass over the rows, without a shuffle.
    """
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_model = codec(model_file)
        for batch in batches:
            texts = batch.column(len(keep))
            for at in range(0, batch.num_rows, 500):
                raw = [with_model.encode_bytes(t or "") for t in texts.slice(at, 500).to_pylist()]
                offsets = np.cumsum([0, *(len(r) // 4 for r in raw)], dtype=np.int32)
                values = np.frombuffer(b"".join(raw), np.int32)
                decoded = [with_model.decode(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, 500) for i in range(len(keep))), ids, pa.array(decoded, pa.string())], names=schema.names)

    return docs.select(*keep, text).mapInArrow(run, schema)
