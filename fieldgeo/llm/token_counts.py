"""Token counts of whole texts under a SentencePiece BPE vocabulary, by a whole-token shortcut.

In no piece of the vocabulary does the space mark follow another character (checked when it is loaded), so no merge
crosses from a character into a space: a text is a sequence of parts, each a run of spaces and what follows it. A part
of one space whose marked form is itself a piece that encodes alone as that one piece is counted by a look-up; only the
rest are merged.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import fresh, prepare, released, texts, tokenizer_path

MARK = "▁"
CROSSING = re.compile("[^▁]▁")
RUNS = re.compile("▁+[^▁]*")


def prove_whole_tokens(processor) -> frozenset[str]:
    """Parts (without the mark) that encode alone as exactly one token; raises where merges could cross a space."""
    n = processor.get_piece_size()
    pieces = [(i, processor.id_to_piece(i)) for i in range(n) if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i))]
    if any(" " in piece or CROSSING.search(piece) for _, piece in pieces) or "".join(processor.encode(" a  ", out_type=str)) != "▁▁a▁▁":
        raise ValueError("the vocabulary merges across spaces; parts can't be counted one by one")
    marked = [(i, p[1:]) for i, p in pieces if p[0] == MARK and len(p) > 1]
    return frozenset(p for (i, p), ids in zip(marked, processor.encode([p for _, p in marked]), strict=True) if ids == [i])


class PartCounts(dict):
    """Tokens by part: the proven whole tokens, and parts merged lately."""

    def __init__(self, path: str, most: int = 150_000):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.base = dict.fromkeys(prove_whole_tokens(self.processor), 1) | {"": 1}
        super().__init__(self.base)
        self.most = most + len(self.base)

    def __missing__(self, part: str) -> int:
        n = len(self.processor.encode(part))
        if len(part) <= 64:
            if len(self) >= self.most:
                self.clear()
                self.update(self.base)
            self[part] = n
        return n

    def of(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " ":
            return sum(self[x[1:].replace(MARK, " ")] for x in RUNS.findall(MARK + text.replace(" ", MARK)))
        return sum(map(self.__getitem__, text.split(" ")))


_loaded: dict[str, PartCounts] = {}


def part_counts(name: str) -> PartCounts:
    if name not in _loaded:
        _loaded[name] = PartCounts(tokenizer_path(name))
    return _loaded[name]


def count_tokens(docs: DataFrame, text: str = "text", model: str = "piece_bpe_32k.model", limit: int = 4096, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns of keep, n_bytes, n_tokens and over_limit of every row; one narrow pass, no shuffle.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows; columns other than keep and text
    aren't read, so that their names may clash with the results'. Texts of any length are counted whole, with some ten times their bytes in a
    task. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    (body,) = fresh(docs.select(*keep), "text")
    chosen = docs.select(*keep, docs[text].alias(body))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches):
        table = part_counts(model)
        for batch in released(batches):
            column = batch.column(batch.num_columns - 1)
            n = pa.array([table.of(x) for x in texts(column)], pa.int64())
            size = pc.fill_null(pc.cast(pc.binary_length(column), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], size, n, pc.greater(n, limit)], names=schema.names)

    return chosen.mapInArrow(count, schema)
