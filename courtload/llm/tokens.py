"""Exact token ids of a tokenizer that drops white space, with the ids of each word kept.

Where a tokenizer's pieces never cross white space, the ids of a text are those of its
space-separated words in turn, so each distinct word is encoded once per worker.
Other tokenizers encode whole texts.
"""

from __future__ import annotations

import functools
import json
from array import array
from pathlib import Path

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Bytes of words and their ids kept per worker process, about, besides those of one call; at the bound the table starts anew,
#: which changes no result.  Longer words than so many characters (texts without spaces) are not kept.
KEPT_BYTES, KEPT_CHARS = 36 << 20, 64

#: Stands for the word end in ranked merging; words with control characters don't go there.
WORD_END = "\x01"

# Fixed value: the split pattern under which no piece holds or looks across white space.
SPACE_FREE_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"



def byte_char(b: int) -> str:
    """The character that byte-level BPE writes for a byte: itself where printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return chr(b) if b in shown else chr(0x100 + b - sum(x < b for x in shown))


class WordTokens:
    def __init__(self, path: str) -> None:
        spec = json.loads(Path(path).read_text())
        spec["truncation"] = spec["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_word = (first.get("pattern", {}).get("Regex") == SPACE_FREE_SPLIT and first.get("behavior") == "Removed"
                        and not spec.get("post_processor")
                        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                    for t in spec["added_tokens"]))
        self.pieces = regex.compile(SPACE_FREE_SPLIT).findall
        self.by_word = self.by_word and self._ranked(spec)
        self.kept: dict[str, bytes] = {}
        self.kept_bytes = 0

    def _ranked(self, spec: dict) -> bool:
        """Merging by rank for single pieces, if ids rise in the order of the merges.

        The word end is written as a byte of its own, which no plain piece holds; a last byte's entry
        with the word end ranks before all merges, so it is formed first, as in the model.  Then two
        neighbours that spell a vocabulary entry are the pair it was merged from.
        """
        model, byte_of = spec["model"], {byte_char(i): i for i in range(256)}
        suffix, added = model.get("end_of_word_suffix") or "", {t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if i not in added}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        single = [i for t, i in vocab.items() if len(t.removesuffix(suffix)) == 1]
        if (not suffix or merged != sorted(merged) or len(single) != 512 or max(single) > merged[0]
                or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback",
                                              "ignore_merges"))):
            return False
        ranks = {bytes(map(byte_of.__getitem__, t.removesuffix(suffix))) + WORD_END.encode() * t.endswith(suffix): i
                 for t, i in vocab.items()}
        self.ranked = tiktoken.Encoding("pieces", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
        return True

    def _alone(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Plain words are merged piece by piece, the others through the whole tokenizer.

        Up to U+00FF normal form C changes nothing and lower case is one character for one.  A mark
        after letters at a word's end is a piece of its own.
        """
        odd, kept, pieces, merge = [], self.kept, self.pieces, self.ranked.encode_ordinary

        def ids(piece: str) -> bytes:
            return array("I", merge(piece + WORD_END)).tobytes()

        for w in words:
            if not w.isprintable() or not (w.isascii() or max(w) < "Ā") or "<" in w or not w:
                odd.append(w)
            elif w.isalpha():
                kept[w] = ids(w.lower())
            elif w[-1] in ".,;:!?" and w[:-1].isalpha():
                if (stem := w[:-1]) not in kept:
                    kept[stem] = ids(stem.lower())
                kept[w] = kept[stem] + ids(w[-1])
            else:
                kept[w] = b"".join(map(ids, pieces(w.lower())))
        kept.update(zip(odd, self._alone(odd)))

    def _plain(self, text: str) -> str:
        """The text with spaces for line ends and, where that changes nothing, in lower case, so that more words are equal."""
        text = text.replace("\n", " ").replace("\t", " ")
        if "<" in text:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return self._alone(texts)
        if self.kept_bytes > KEPT_BYTES:
            self.kept.clear()
            self.kept_bytes = 0
        split = [self._plain(t).split(" ") for t in texts]
        before, new = len(self.kept), [*set().union(*split).difference(self.kept)]
        self._learn(new)
        out = [b"".join(map(self.kept.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > KEPT_CHARS:
                del self.kept[w]
                self.kept.pop(w[:-1], None)   # a stem learnt along with it
        # a word's entry, text and ids: about 170 bytes, and 1 to 4 more a character
        self.kept_bytes += 180 * (len(self.kept) - before) + sum(4 * len(w) for w in new if len(w) <= KEPT_CHARS)
        return out


@functools.lru_cache(1)
def word_tokens(path: str) -> WordTokens:
    """One table per worker process, kept between its tasks."""
    return WordTokens(path)
