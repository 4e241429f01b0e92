"""Token ids from the public tokenizers, with a memo of words where a vocabulary allows one."""

from __future__ import annotations

import hashlib
import json
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from peakframe.llm.common import kept

#: Entries of a generation of the memo of words that a worker keeps, their cores (lower case, without the marks behind) among them. About 250 bytes each, in two generations.
MEMO = 180_000
#: Texts whose words are looked up together.
GROUP = 1024
#: What Python and the library surely treat alike: letters up to here are letters to both, and composed.
PLAIN_END = "ɐ"
#: The normalizer and the splits that the memo assumes (dropped white space, lower case, runs of letters, single digits, runs of marks).
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Marks that, in any run behind a word of letters, the library splits off as one part.
ENDS = ".,;:!?$&%*#"


class Memo:
    """Values by key, at most `most` in each of two generations: when the younger is full it becomes the older, from which what is asked for again comes back."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def lacking(self, keys: set[str]) -> set[str]:
        """The keys whose values must still be put into `now`, which holds those of all the others."""
        missing = keys.difference(self.now)
        back = {k: self.before[k] for k in missing if k in self.before}
        if len(self.now) + len(missing) > self.most:
            back.update({k: self.now[k] for k in keys.difference(missing)})
            self.now, self.before = {}, self.now
        self.now.update(back)
        return missing.difference(back)


def version(path: str) -> str:
    """Digest of a tokenizer's file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def joined(values: list[bytes], indices: pa.Array, offsets: pa.Array) -> list[bytes]:
    """For each run of indices between two offsets, the values they name, joined."""
    if not len(indices):
        return [b""] * (len(offsets) - 1)
    laid = pa.array(values, pa.large_binary()).take(indices)
    _, ends, data = laid.buffers()
    at = np.frombuffer(ends, dtype="<i8", count=len(laid) + 1)[offsets.to_numpy()].tolist()
    view = memoryview(data) if data else b""
    return [bytes(view[i:j]) for i, j in zip(at, at[1:], strict=False)]


class JsonTokenizer:
    """Ids of whole texts as the tokenizers library gives them, as little-endian unsigned 32-bit bytes.

    If the file has exactly the normalizer and splits that the memo assumes, and ends each word's last token with a suffix, words are encoded once and remembered; else texts go to the library as they are.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and each thread would keep memory of its own
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        said = json.loads(Path(path).read_text())
        model, added = said["model"], said.get("added_tokens") or []
        suffix = model.get("end_of_word_suffix")
        # a file that differs in any of this is left to the library
        self.by_word = (
            bool(suffix)
            and not model.get("dropout")
            and (said.get("normalizer") or {}).get("normalizers") == NORMALIZER
            and (said.get("pre_tokenizer") or {}).get("pretokenizers") == SPLITS
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t.get("normalized") or any(c.isspace() for c in t["content"]) for t in added)
        )
        if self.by_word:
            self.ends = np.zeros(self.library.get_vocab_size(), dtype=bool)
            self.ends[[i for t, i in self.library.get_vocab().items() if t.endswith(suffix)]] = True
            self.memo = Memo(MEMO)

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[str]) -> None:
        """Put white-space-free words that the memo lacks into it. Most are a core of letters, some with marks behind; cores are encoded many at a time, and are entries of the memo themselves."""
        now, before = self.memo.now, self.memo.before
        parts, split, other = set(), [], []
        for w in words:
            core = w.rstrip(ENDS)
            if core.isalpha() and (core.isascii() or max(core) < PLAIN_END):
                end, core = w[len(core) :], core.lower()
                parts.add(core)
                if end:
                    parts.add(end)
                if core != w:
                    split.append((w, core, end))
            else:
                other.append(w)
        new = [x for x in parts if x not in now and x not in before]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            ids = np.frombuffer(b"".join(self.raw([" ".join(part[j : j + 500]) for j in range(0, len(part), 500)])), dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):  # not as foreseen: one at a time
                now.update(zip(part, self.raw(part), strict=True))
                continue
            data, at = ids.tobytes(), 0
            for x, b in zip(part, (4 * cuts).tolist(), strict=True):
                now[x] = data[at:b]
                at = b
        of = lambda x: now[x] if x in now else before[x]
        for w, core, end in split:
            now[w] = of(core) + of(end) if end else of(core)
        now.update(zip(other, self.raw(other), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self.raw(texts)
        out: list[bytes] = []
        for a in range(0, len(texts), GROUP):
            group = texts[a : a + GROUP]
            words = pc.utf8_split_whitespace(pa.array(group, pa.large_string()))  # white space as Python has it
            coded = words.flatten().dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            keys = set(distinct).difference([""])  # outer white space leaves empty words
            if len(keys) > self.memo.most:
                out += self.raw(group)
                continue
            if missing := self.memo.lacking(keys):
                self.learn(missing)
            memo = self.memo.now
            got = joined([memo[w] if w else b"" for w in distinct], coded.indices, words.offsets)
            for i, t in enumerate(group):
                if "\x1c" in t or "\x1d" in t or "\x1e" in t or "\x1f" in t:  # white space to Python only
                    got[i] = self.raw([t])[0]
            out += got
        return out


class PieceTokenizer:
    """The same for sentencepiece models."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, dtype="<u4").tobytes() for ids in self.library.encode(texts, num_threads=1)]


def tokenizer(name: str):
    """The tokenizer of a public file name (or path), loaded once in each Python process and kept while nothing else is."""
    import public_tokenizers

    path = name if "/" in name else public_tokenizers.path(name)
    return kept(f"tokenizer-{path}", lambda: PieceTokenizer(path) if path.endswith(".model") else JsonTokenizer(path))
