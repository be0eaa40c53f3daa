"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file is read from a path parameter, once per Python worker. Texts
longer than ``PIECE_CHARS`` are cut before encoding, only at boundaries where
the splitting pattern always ends a match, so the ids are those of the whole
text. Decoding joins the ids' raw bytes, so it is right for ids that cut a
code point.

Nulls encode as the empty text (no ids). Lone surrogates cannot occur in
Spark strings. Further input columns are ignored; repeated rows give repeated
results; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableload.llm.common import text_of

#: Code points handed to the encoder at once, about.
PIECE_CHARS = 200_000

#: Between these two characters a match of the pattern always ends: ASCII white
#: space begins after anything else, or the class changes after a letter or a
#: digit. Only characters that every Unicode version classes alike are named.
_SAFE = regex.compile(
    r"(?<=\S)(?=[ \t\n\r\f\v])"
    r"|(?<=[A-Za-z\u3041-\u3096\u4e00-\u9fa5\uac00-\ud7a3])(?=[!-@\u3001\u3002\uff0c])"
    r"|(?<=[0-9])(?=[!-/:-@A-Za-z])"
)


@lru_cache(maxsize=4)
def encoding(rank_path: str, pattern: str):
    """The tiktoken encoding of a local rank file (``base64 rank`` a line), without special tokens."""
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at safe boundaries into pieces of ``size`` code points or slightly more.

    A stretch without any boundary (one endless word) stays whole.
    """
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None or m.start() >= len(text):
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def encode(text: str, enc) -> np.ndarray:
    """Ids of a whole text."""
    if len(text) <= PIECE_CHARS:
        return np.asarray(enc.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.asarray(enc.encode_ordinary(p), dtype="<u4") for p in safe_pieces(text)])


def decode(ids: np.ndarray, enc) -> bytes:
    """Raw bytes of the ids, in slices so that no long Python list is made."""
    return b"".join(enc.decode_bytes(ids[i : i + PIECE_CHARS].tolist()) for i in range(0, len(ids), PIECE_CHARS))


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, keep_ids: bool = True, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens, ids (array<int>, when ``keep_ids``), ids_sha256 and decoded_sha256 for every document.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers,
    decoded_sha256 over the bytes the ids decode to. One pass, no shuffle;
    Arrow batches are bounded by rows and bytes.
    """
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    body = docs.select(*keep, text_of().alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in body.schema[: len(keep)])

    def run(batches):
        enc = encoding(rank_path, pattern)
        for pdf in batches:
            out = {c: pdf[c] for c in keep}
            n, sha, back, all_ids = [], [], [], []
            for text in pdf["__text"]:
                ids = encode(text, enc)
                n.append(len(ids))
                sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back.append(hashlib.sha256(decode(ids, enc)).hexdigest())
                if keep_ids:
                    all_ids.append(ids.astype("int32"))
            frame = pdf[list(out)].copy()
            frame["n_tokens"], frame["ids_sha256"], frame["decoded_sha256"] = n, sha, back
            if keep_ids:
                frame["ids"] = all_ids
            yield frame

    return body.mapInPandas(run, schema=f"{schema}, {fields}")


def decode_documents(tokens: DataFrame, rank_path: str, pattern: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, decoded binary) of rows that hold token ids; null ids decode to no bytes."""

    def run(batches):
        enc = encoding(rank_path, pattern)
        for pdf in batches:
            out = pdf[[key]].copy()
            out["decoded"] = [b"" if x is None else decode(np.asarray(x, dtype="<u4"), enc) for x in pdf["__ids"]]
            yield out

    body = tokens.select(key, F.col(ids).alias("__ids"))
    return body.mapInPandas(run, schema=f"`{key}` {body.schema[0].dataType.simpleString()}, decoded binary")
