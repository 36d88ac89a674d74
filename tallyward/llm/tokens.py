"""Token ids of whole Arrow batches, from a public tokenizer's file."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a worker remembers, and words encoded in one call.
_REMEMBERED = 300_000
_AT_ONCE = 10_000


class Encoder:
    """Ids of texts by a tokenizer given as the content of its JSON file, without special tokens.

    ``wordwise`` is for tokenizers that drop white space, lower the case and never join
    across it: distinct words are then encoded once per batch and remembered. The result
    is the same; ``separator`` is one of the tokenizer's special tokens. Texts that may
    hold special tokens are encoded as they are.
    """

    def __init__(self, content: str, wordwise: bool, separator: str = "<|endoftext|>"):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.wordwise, self.separator = wordwise, separator
        self.mark = self.tokenizer.token_to_id(separator)
        self.memory: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if not self.wordwise:
            return self._direct(texts.to_pylist())
        odd = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._by_words(texts)
        direct, direct_n = self._direct(texts.filter(pa.array(odd)).to_pylist())
        words, words_n = self._by_words(texts.filter(pa.array(~odd)))
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[odd], counts[~odd] = direct_n, words_n
        of_odd = np.repeat(odd, counts)
        ids = np.empty(int(counts.sum()), dtype=np.uint32)
        ids[of_odd], ids[~of_odd] = direct, words
        return ids, counts

    def _direct(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(f) for f in found], dtype=np.int64)
        return np.concatenate([np.array(f, dtype=np.uint32) for f in found] or [np.zeros(0, np.uint32)]), counts

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        # a sign other than an apostrophe always starts a new token after a letter or digit
        parted = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z0-9])([!-&(-/:-@\[-`{-~])", r"\1 \2")
        lists = pc.ascii_split_whitespace(parted)
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        known = self._word_ids(coded.dictionary.to_pylist())
        sizes = np.array([len(k) for k in known], dtype=np.int64) >> 2
        pool = np.frombuffer(b"".join(known), dtype="<u4")
        begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        amount = sizes[at]
        ends = np.cumsum(amount)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.arange(total) + np.repeat(begins[at] - (ends - amount), amount)]
        edges = np.concatenate([[0], np.cumsum(per_text)])
        sums = np.concatenate([[0], ends])
        return ids, sums[edges[1:]] - sums[edges[:-1]]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        memory = self.memory
        known = [memory.get(w) for w in words]
        fresh = [k for k, ids in enumerate(known) if ids is None]
        for at in range(0, len(fresh), _AT_ONCE):
            some = fresh[at : at + _AT_ONCE]
            joined = self.separator.join([words[k] for k in some])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.concatenate([[-1], np.flatnonzero(ids == self.mark), [len(ids)]])
            raw = ids.tobytes()
            for k, a, b in zip(some, (cuts[:-1] + 1).tolist(), cuts[1:].tolist(), strict=True):
                known[k] = raw[4 * a : 4 * b]
                if len(memory) < _REMEMBERED:
                    memory[words[k]] = known[k]
        return known


@lru_cache(maxsize=2)
def encoder(content: str, wordwise: bool) -> Encoder:
    """One encoder per worker process."""
    return Encoder(content, wordwise)
