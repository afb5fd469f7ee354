"""Token counts of document sections from one encoding of the whole document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.tokens import encoder

SECTIONS = "doc_id long, field string, section int, start_char long, end_char long, n_tokens long, token_share double"
RULES = ("start", "end", "most")


def token_counts(docs: DataFrame, tokenizer: str, fields: tuple[str, ...] = ("text",), separator: str = "\n", rule: str = "start", id_col: str = "doc_id") -> DataFrame:
    """Tokens of each section of each document, as SECTIONS rows.

    A document is its fields joined by ``separator``; it is encoded once, as a
    whole, so the counts of its sections add up to its own. A section ends after
    each separator, which belongs to it. Spans are code points of the joined text.

    A token that crosses a boundary goes, by ``rule``, to the section of its
    first byte ("start") or last byte ("end"), or to the one that its middle lies
    in ("most", ties to the earlier), which of two sections is the one with more of it. ``token_share`` splits it by bytes instead;
    both columns sum to the document's tokens.

    A null or empty field is one empty section without tokens. A repeated row
    gives its sections again. An empty table gives no row.
    """
    if rule not in RULES or not separator:
        raise ValueError(f"rule must be one of {RULES} and separator not empty")
    names = list(fields)

    def run(batches):
        enc = encoder(tokenizer)
        sizes = enc.sizes if enc.kind == "joined" else None
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                cols = [[x or "" for x in c.to_pylist()] for c in part.columns[1:]]
                yield _count(part.column(0).to_pylist(), list(zip(*cols)), names, enc, sizes, separator, rule)

    cols = [F.col(f).cast("string").alias(f"_{i}") for i, f in enumerate(names)]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *cols).mapInArrow(run, SECTIONS)


def _count(ids, docs, names, enc, sizes, separator, rule):
    texts = [separator.join(d) for d in docs]
    if sizes is not None:
        edges = [np.concatenate(([0], np.cumsum(sizes[np.frombuffer(x, "<u4")]))) for x in enc.batch(texts)]
        spans = [(e[:-1], e[1:]) for e in edges]
    else:
        pairs = [np.array(e.offsets, np.int64).reshape(-1, 2) for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
        spans = [(p[:, 0], p[:, 1]) for p in pairs]
    out = [[] for _ in range(7)]
    for doc_id, fields, text, (lo, hi) in zip(ids, docs, texts, spans):
        parts, field, section = [], [], []
        for f, value in enumerate(fields):
            lines = value.split(separator)
            parts += lines
            field += [names[f]] * len(lines)
            section += range(len(lines))
        chars = np.cumsum([len(p) + len(separator) for p in parts])
        chars[-1] = len(text)
        if sizes is not None:
            cut = np.cumsum([len(p.encode("utf-8")) + len(separator.encode()) for p in parts])
            cut[-1] = len(text.encode("utf-8"))
            if len(hi) and hi[-1] != cut[-1]:
                raise ValueError("the tokenizer does not keep every byte of a text")
        else:
            cut = chars
        if rule == "start":
            upto = np.searchsorted(lo, cut, "left")
        elif rule == "end":
            upto = np.searchsorted(hi, cut, "right")
        else:
            upto = np.searchsorted(lo + hi, 2 * cut, "right")
        upto[-1] = len(lo)
        x, y = np.stack([lo, hi], 1).ravel(), np.repeat(np.arange(len(lo) + 1), 2)[1:-1]
        share = np.interp(cut, x, y) if len(lo) else np.zeros(len(cut))
        for col, v in zip(out, ([doc_id] * len(parts), field, section, np.concatenate(([0], chars[:-1])).tolist(), chars.tolist(), np.diff(upto, prepend=0).tolist(), np.diff(share, prepend=0.0).tolist())):
            col += v
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "field", "section", "start_char", "end_char", "n_tokens", "token_share"])
