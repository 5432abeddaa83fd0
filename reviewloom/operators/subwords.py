"""Token counts of a subword vocabulary, for scorers whose counts should be those of a model's tokenizer.

Words are split in the JVM; only they go to Python, as Arrow arrays, and each distinct word of a batch is counted once.
"""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# What is a word of its own, the mark of a piece that continues a word, and the longest word that is cut.
WORD_PATTERN = r"[\p{P}\p{S}]|[^\p{P}\p{S}\s]+"
CONTINUED = "##"
MAX_WORD_CHARACTERS = 100


def piece_trie(pieces: Iterable[str]) -> dict:
    """Characters to sub-tries; a node that ends a piece has the key ``""``."""
    root = {}
    for piece in pieces:
        node = root
        for character in piece:
            node = node.setdefault(character, {})
        node[""] = True
    return root


def subword_counter(vocabulary: Iterable[str]) -> Callable[[Column], Column]:
    """A function from a text column to the number of its subword tokens (null for null, 0 for a text without words).

    From the left, the longest piece that fits is taken, ``##`` pieces after the first. A word that cannot be cut so,
    or has more than ``MAX_WORD_CHARACTERS``, is one token. The vocabulary travels with the function, so it is for
    vocabularies of tokenizers (some ten thousand pieces), and need not be in any file the executors can reach.
    """
    pieces = list(vocabulary)
    if any(not piece.removeprefix(CONTINUED) for piece in pieces):
        raise ValueError("a piece must have a character")
    first = [piece for piece in pieces if not piece.startswith(CONTINUED)]
    later = [piece.removeprefix(CONTINUED) for piece in pieces if piece.startswith(CONTINUED)]
    longest_word, build = MAX_WORD_CHARACTERS, piece_trie

    @F.arrow_udf("int")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        begins, continues = build(first), build(later)

        def pieces_of(word):
            at, n, node = 0, 0, begins
            if len(word) > longest_word:
                return 1
            while at < len(word):
                end, step = 0, at
                while step < len(word) and (node := node.get(word[step])) is not None:
                    step += 1
                    if "" in node:
                        end = step
                if not end:
                    return 1
                at, n, node = end, n + 1, continues
            return n

        for words in batches:
            coded = words.flatten().dictionary_encode()
            per_word = np.array([pieces_of(word) for word in coded.dictionary.to_pylist()] or [0], np.int64)
            lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            before = np.concatenate([[0], np.cumsum(per_word[coded.indices.to_numpy()])]) if len(coded) else np.zeros(1, np.int64)
            ends = np.cumsum(lengths, dtype=np.int64)
            totals = before[ends] - before[ends - lengths]
            yield pa.array(totals.astype(np.int32), pa.int32(), mask=words.is_null().to_numpy(zero_copy_only=False))

    return lambda text: count(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)))
