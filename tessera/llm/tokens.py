"""Token counts under a unigram model, over a trie of distinct pre-tokens.

A pre-token is a word with a space before it. Its tokens are the pieces of the best
segmentation: the highest sum of piece scores, then the fewest pieces. Forward scores are a
dynamic program over prefixes, so two words with a common prefix share its states: distinct
words are walked in sorted order, which is the depth-first order of their trie, and only the
part beyond the common prefix is computed. The count at a word's end is stored for the word.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, slices, utf8

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def pieces(path: str) -> dict[bytes, float | None]:
    """The trie of pieces: the log score of each, by Zipf's law over its rank, and None for prefixes that are none.

    The vocabulary has ranks and no scores, and is not trained here.
    """
    with open(path, "rb") as lines:
        scores = {base64.b64decode(a): -math.log(int(b) + 2) for a, b in map(bytes.split, lines)}
    return dict.fromkeys((p[:k] for p in scores for k in range(1, len(p)))) | scores


_NO_PREFIX = object()


def count_words(words: Iterable[bytes], trie: dict[bytes, float | None]) -> dict[bytes, int]:
    """Tokens of each distinct word, by one walk over their trie. Single bytes are pieces, so every word has some.

    At each depth are kept the best score, its number of pieces, and the starts from which some piece goes on: a start is
    followed no further than the trie of pieces reaches.
    """
    out: dict[bytes, int] = {}
    best, count = [0.0], [0]  # at each depth of the path in the trie
    alive: list[list[int]] = [[]]
    last = b""
    get = trie.get
    for word in sorted(set(words)):
        node = b" " + word
        same = 0
        for a, b in zip(last, node, strict=False):
            if a != b:
                break
            same += 1
        del best[same + 1 :], count[same + 1 :], alive[same + 1 :]
        for end in range(same + 1, len(node) + 1):
            top, few, on = -math.inf, 0, []
            for start in (*alive[-1], end - 1):
                score = get(node[start:end], _NO_PREFIX)
                if score is _NO_PREFIX:
                    continue
                on.append(start)
                if score is not None:
                    score += best[start]
                    if score > top or score == top and count[start] < few:
                        top, few = score, count[start]
            alive.append(on)
            best.append(top)
            count.append(few + 1)
        last = node
        out[word] = count[-1]
    return out


def token_counts(
    docs: DataFrame, text_col: str = "text", path: str | None = None, held_words: int = 1 << 20
) -> tuple[DataFrame, list[str]]:
    """Every row of docs with n_words and n_tokens (underscores before names that docs has), and the two names.

    A null or empty text has 0 of both; words of any length are segmented whole; repeated rows count alike; an empty
    table stays empty. A task keeps the counts of up to held_words words between blocks of text, which is only a cache.

    path: the vocabulary; by default what the session names in tessera.tokens.vocabulary, else VOCABULARY. Every executor
    has to have that file.
    """
    path = path or docs.sparkSession.conf.get("tessera.tokens.vocabulary", VOCABULARY)
    names = fresh(docs, "n_words", "n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = pieces(path)
        known: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, text_col):
                split = [t.split() if t else [] for t in utf8(part.column(text_col))]
                if len(known) > held_words:
                    known = {}
                known |= count_words(set().union(*split) - known.keys(), trie)
                made = [
                    pa.array([len(w) for w in split], pa.int64()),
                    pa.array([sum(map(known.__getitem__, w)) for w in split], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    return docs.mapInArrow(run, schema), names


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of docs: id, n_words, n_tokens (see token_counts)."""
    out, (words, tokens) = token_counts(docs.select(id_col, text_col), text_col, **options)
    return out.select(F.col(id_col), F.col(words).alias("n_words"), F.col(tokens).alias("n_tokens"))
