"""Token counts without token ids.

No piece of the model crosses certain boundaries, so the ids of a text are those of
its pre-tokens, one after another. The pieces of every distinct pre-token are counted
once, by the library itself; a document sums them by its pre-token frequencies."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import stored
from .parts import document_parts, document_sums, hot_parts, part_counts

#: A pre-token of more characters than this is cut on between characters that no piece holds side by side.
LONG = 64
#: A character outside the vocabularies: what follows it is encoded as if alone.
GUARD = "\ue000"


class PreTokens:
    """Cuts a text where no merge can reach across, and counts the pieces of the parts."""

    def __init__(self, model_file: str):
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if m.normalize("a  ﬁ ") != "▁a▁▁ﬁ▁":
            raise ValueError("the model changes texts before it cuts them; counts by pre-token need one that does not")
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())
                 if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        self.pairs = {a + b for p in names for a, b in zip(p.replace("▁", " "), p.replace("▁", " ")[1:])}
        if any(GUARD in p for p in names):
            raise ValueError("the guard character is in the vocabulary")
        self.guard = len(m.encode(GUARD))
        crossed = any(re.search("[^▁]▁|.\n|\n.", p) for p in names)
        self.cut = re.compile("(?s).+" if crossed else " +[^ \n]*|\n|[^ \n]+").findall

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a space and the text, which they give back when joined. The model takes
        U+2581 for a space, so do they."""
        parts = self.cut(" " + text.replace("▁", " "))
        if max(map(len, parts)) <= LONG:
            return parts
        out = []
        for p in parts:
            if len(p) <= LONG:
                out.append(p)
                continue
            pairs, at = self.pairs, 0
            for i in range(1, len(p)):
                if p[i - 1:i + 1] not in pairs:
                    out.append(p[at:i])
                    at = i
            out.append(p[at:])
        return out

    def counts(self, parts: list[str]) -> list[int]:
        """Pieces of each pre-token. The model puts one space before what it is given."""
        given = [p[1:] if p[0] == " " and len(p) > 1 else GUARD + p for p in parts]
        out = []
        for p, g, ids in zip(parts, given, self.model.encode(given, num_threads=1) if given else []):
            out.append(len(ids) - self.guard if g[0] == GUARD and len(g) == len(p) + 1 else len(ids))
        return out


@lru_cache(maxsize=2)
def pretokens(model_file: str) -> PreTokens:
    return PreTokens(model_file)


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id long, n_bytes long, n_tokens long), one row per row of ``docs``: UTF-8 bytes
    and tokens of the whole text, as the SentencePiece model gives them without begin and end.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted each; a null
    doc_id stays null; an empty table gives an empty result; only doc_id and text are read,
    so other columns may have any name. A long text without spaces is cut between characters
    that no piece holds side by side; what can't be cut is one pre-token of its whole length."""
    split = lambda: pretokens(model_file).split

    def count(batches):
        p = pretokens(model_file)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p.counts(b.column(0).to_pylist()), pa.int64())],
                                             names=["part", "n", "n_tokens"])

    lexicon = stored(part_counts(docs, split).mapInArrow(count, "part string, n long, n_tokens long"), "pretokens")
    rows = document_parts(docs, split, hot_parts(lexicon, ["n_tokens"]), "pretoken-rows")
    return document_sums(rows, lexicon, "n_tokens")
