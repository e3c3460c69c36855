"""Token ids of texts by a public tokenizer that treats white space as a divider.

The tokenizer divides a text at white space, so the ids of a text are those of its words one after
another; and a word between letters or digits and other marks, so the ids of a word are those of its
runs. Each distinct word is looked at and each distinct run encoded once per worker process, as long
as it is remembered; texts are put together from the table of words with numpy.

If the tokenizer marks the last id of a word, runs of small Latin letters, which it leaves as they are
and never divides before its merges, are encoded many at a time as one text.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers at most (some 200 bytes each), and how many of the most used it keeps then.
REMEMBERED_WORDS = 200_000
KEPT_WORDS = 120_000
#: Plain runs encoded as one text.
JOINED_RUNS = 100
_RUN = re.compile(r"[^\W_]+|(?:[^\w]|_)+")
#: Composed, lower-cased letters that no version of Unicode treats otherwise.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


class _Numbers(dict):
    """Numbers strings in the order of their first lookup."""

    def __missing__(self, text: str) -> int:
        self[text] = number = len(self)
        return number


def _joined(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray):
    """The parts ``chosen`` of a pool one after another, and where each ends."""
    own = sizes[chosen]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts[chosen] - (ends - own), own) + np.arange(total)], ends


class Words:
    """Ids by word: those of word ``k`` are ``pool[starts[k] : starts[k] + sizes[k]]``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model without normalizing and dividing, and which of its ids end a word.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab() if suffix else {}
        self.closing = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.closing[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.words = _Numbers()
        self.starts = self.sizes = self.used = np.zeros(0, np.int64)
        self.ends = np.zeros(0, bool)
        self.pool = np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the words used most."""
        chosen = np.sort(np.argpartition(-self.used, KEPT_WORDS)[:KEPT_WORDS])
        every = list(self.words)
        self.words = _Numbers((every[k], n) for n, k in enumerate(chosen.tolist()))
        self.pool, ends = _joined(self.pool, self.starts, self.sizes, chosen)
        self.sizes, self.ends, self.used = self.sizes[chosen], self.ends[chosen], self.used[chosen]
        self.starts = ends - self.sizes

    def _encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain runs: each ends with its only closing id."""
        texts = [" ".join(words[k : k + JOINED_RUNS]) for k in range(0, len(words), JOINED_RUNS)]
        encoded = self.plain.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in encoded), np.int32)
        return ids, np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)

    def _encode_new(self) -> None:
        known = len(self.sizes)
        composite: list[int] = []
        counts, parts = [], []
        for k, word in enumerate(list(itertools.islice(self.words, known, None)), known):
            # Whole: what is joined across marks (contractions, special tokens, the dot of a lower-cased İ) or
            # composed of several characters.
            if word.isalnum() or "'" in word or "<|" in word or "İ" in word or not (word.isascii() or _composed(word)):
                continue
            runs = _RUN.findall(word)
            if len(runs) > 1:
                composite.append(k)
                counts.append(len(runs))
                parts += [self.words[run] for run in runs]  # runs are words too, and new ones follow
        new = list(itertools.islice(self.words, known, None))
        if not new:
            return
        whole = np.ones(len(new), bool)
        whole[np.array(composite, np.int64) - known] = False
        sizes, starts = np.zeros((2, len(new)), np.int64)
        plain = np.fromiter(map(bool, map(_PLAIN.fullmatch, new)), bool, len(new)) & whole & bool(len(self.closing))
        for chosen, encoded in ((plain, self._encode_plain), (whole & ~plain, self._encode_each)):
            ids, sizes[chosen] = encoded(list(itertools.compress(new, chosen.tolist())))
            starts[chosen] = len(self.pool) + np.cumsum(sizes[chosen]) - sizes[chosen]
            self.pool = np.concatenate([self.pool, ids])
        self.sizes, self.starts = np.concatenate([self.sizes, sizes]), np.concatenate([self.starts, starts])
        values, ends = _joined(self.pool, self.starts, self.sizes, np.array(parts, np.int64))
        word_ends = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        self.sizes[composite] = np.diff(word_ends)
        self.starts[composite] = len(self.pool) + word_ends[:-1]
        self.pool = np.concatenate([self.pool, values])
        self.ends = np.concatenate([self.ends, np.array([w[-1:] in (".", "!", "?") and w != "" for w in new], bool)])
        self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts together, tokens before each text (one more at the end), sentence ends."""
        if len(self.words) > REMEMBERED_WORDS:
            self._forget()
        cleaned = []
        for text in texts:
            low = text.lower()
            # Lower-casing first leaves fewer words; not where it depends on context or could make a special token.
            if text.isascii() or "Σ" not in text and "İ" not in text and _composed(text) and _composed(low):
                text = low if "<|" not in text else text
            cleaned.append(text.replace("\n", " "))
        divided = pc.split_pattern(pa.array(cleaned, pa.large_string()), " ")
        counts = np.concatenate([[0], np.cumsum(divided.value_lengths().to_numpy())])
        words = divided.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        self._encode_new()
        self.used += np.bincount(numbers, minlength=len(self.used))
        ids, ends = _joined(self.pool, self.starts, self.sizes, numbers)
        at = np.concatenate([[0], ends])[counts]
        return ids, at, ends[self.ends[numbers]]


def _composed(text: str) -> bool:
    return unicodedata.is_normalized("NFC", text)


def words_of(path: str) -> Words:
    """The table of this worker process; it outlives a task."""
    held = sys.modules.setdefault("_tidegauge_words", types.ModuleType("_tidegauge_words"))
    if getattr(held, "path", None) != path:
        held.path, held.words = path, Words(path)
    return held.words
