"""Token ids by the ``tokenizers`` library, with a cache of the pieces between white space.

The library's encoding of a text is the concatenation of the encodings of its
pre-tokens.  Texts repeat their words, so they are cut at places where the
tokenizer certainly cuts too; the pieces are found again by 64-bit names, all at once in
numpy, and compared in full (see ``span_words``) wherever names agree; each distinct piece is
encoded once per Python worker, and a text's ids are gathered from the cached pieces.
Texts with unusual white space, and tokenizers of an unknown kind, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from .common import hashed_words, span_words, worker_cache

#: code points of white space, and near it, that the tokenizers' patterns may judge differently than this module;
#: 0 stands between texts
ODD = re.compile(
    "[" + "".join(map(chr, [0, 9, 11, 12, 13, *range(28, 32), 133, 160, 5760, 6158, *range(8192, 8208)]))
    + "".join(map(chr, [8232, 8233, 8239, 8287, 12288, 65279])) + "]"
)
PLAIN_SPACE = re.compile("(?<=[^ \n]) (?=[^ \n])")
LONG = 1 << 22  # longer texts are cut at a plain space
MAX_PIECES = 1_000_000  # cached pieces of one worker; beyond it new ones are encoded each time
BETWEEN, SPACE, LINE, LETTER, OTHER, WIDE = range(6)
CLASS = np.array(
    [
        BETWEEN if b == 0 else SPACE if b == 32 else LINE if b == 10 else WIDE if b > 127 else LETTER if chr(b).isalpha() else OTHER
        for b in range(256)
    ],
    dtype=np.uint8,
)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

def _kind(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in spec.get("added_tokens", [])):
        return "whole"
    if pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not norm:
        return "byte"
    parts = pre.get("pretokenizers", [])
    if (
        [p.get("type") for p in parts] == ["Split", "ByteLevel"]
        and parts[0].get("behavior") == "Removed"
        and parts[0].get("invert")
        and not parts[1].get("add_prefix_space")
        and "\\s" in str(parts[0].get("pattern"))
        and [n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    ):
        return "word"
    return "whole"


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two (names, places) tables in ascending order of names as one."""
    names = np.concatenate([a[0], b[0]])
    order = np.argsort(names, kind="stable")
    return names[order], np.concatenate([a[1], b[1]])[order]


class PieceEncoder:
    """Encodes batches of texts; equal to ``Tokenizer.encode(text, add_special_tokens=False)`` of each.

    Strings that look like special tokens are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task, as Spark scheduled it
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.kind = _kind(path)
        self.line = (self.tok.encode("\n", add_special_tokens=False).ids or [-1])[0]
        vocabulary = self.tok.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # bytes that a token stands for
        for token, i in vocabulary.items():
            self.width[i] = len(token.removesuffix("</w>") if self.kind == "word" else token)
        self.salt = 0
        self._reset()

    def _reset(self) -> None:
        # names of the cached pieces in ascending order, with their places; the newer ones apart, merged now and then
        self.old = self.new = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32))
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = self.pieces = 0
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.count = np.zeros(1 << 14, dtype=np.int32)
        self.words = np.zeros((3, 1 << 14), dtype=np.uint64)  # of the pieces, to compare them

    def _find(self, names: np.ndarray) -> np.ndarray:
        """The places of ascending names; -1 for unknown ones."""
        out = np.full(len(names), -1, dtype=np.int64)
        for known, place in (self.old, self.new):
            if len(known):
                i = np.minimum(np.searchsorted(known, names), len(known) - 1)
                hit = known[i] == names
                out[hit] = place[i[hit]]
        return out

    def _remember(self, names: np.ndarray, places: np.ndarray) -> None:
        self.new = merged(self.new, (names, places.astype(np.int32)))
        if 8 * len(self.new[0]) > len(self.old[0]):
            self.old, self.new = merged(self.old, self.new), (self.new[0][:0], self.new[1][:0])

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        n = np.array([len(g) for g in got], dtype=np.int64)
        return np.array([i for g in got for i in g], dtype=np.uint32), n

    def _together(self, groups: list[list[str]], glue: str) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids of each piece) of groups of pieces, each encoded as one text and told apart by the tokens' widths."""
        out = []
        texts = [glue.join(g) for g in groups]
        for group, e in zip(groups, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=np.uint32)
            if glue == "\n":
                ids = ids[ids != self.line]
            ends, want = np.cumsum(self.width[ids]), np.cumsum([len(p.encode()) for p in group])
            at = np.searchsorted(ends, want)
            if not len(ends) or at[-1] != len(ends) - 1 or (ends[at] != want).any():
                out.append(self._each(group))  # the widths don't add up
            else:
                out.append((ids, np.diff(at, prepend=-1)))
        return out

    def _learn(self, pieces: list[str], words: np.ndarray) -> np.ndarray:
        """Encode new pieces; their places."""
        if self.kind == "byte":
            spaced = [i for i, p in enumerate(pieces) if p[0] == " " and p[1:2] not in ("", " ", "\n")]
            bare = [i for i, p in enumerate(pieces) if p[0] not in " \n"]
            rest = [i for i, p in enumerate(pieces) if not (p[0] == " " and p[1:2] not in ("", " ", "\n")) and p[0] in " \n"]
            groups = [(spaced, ""), (bare, "\n"), (rest, None)]
        else:
            plain = [i for i, p in enumerate(pieces) if p.isascii()]
            groups = [(plain, " "), ([i for i, p in enumerate(pieces) if not p.isascii()], None)]
        order, ids, counts = [], [], []
        for members, glue in groups:
            order += members
            some = [[pieces[i] for i in members[a : a + 256]] for a in range(0, len(members), 256)]
            for got, n in [self._each(g) for g in some] if glue is None else self._together(some, glue):
                ids.append(got)
                counts.append(n)
        flat, n, k = np.concatenate(ids), np.concatenate(counts), self.pieces
        while k + len(n) > len(self.start):
            self.start, self.count = np.resize(self.start, 2 * len(self.start)), np.resize(self.count, 2 * len(self.count))
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, len(self.flat) * 3 // 2)
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[k : k + len(n)] = self.used + np.cumsum(n) - n
        self.count[k : k + len(n)] = n
        self.words[:, k : k + len(n)] = words[:, order]
        self.used += len(flat)
        self.pieces += len(n)
        places = np.empty(len(n), dtype=np.int64)
        places[order] = np.arange(k, k + len(n))
        return places

    def _segments(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) of the pieces of texts with a 0 byte before each and after the last."""
        kind = CLASS[data]
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # the Latin-1 letters
        kind[latin] = kind[latin + 1] = LETTER
        solid = kind >= LETTER
        before = np.concatenate([[False], solid[:-1]])
        was = np.concatenate([[BETWEEN], kind[:-1]])
        start = (solid & ~before) | (~solid & before) | ((kind == OTHER) & (was == LETTER))
        if self.kind == "byte":  # a space before a word belongs to it; the last of several white spaces stands alone
            after = np.concatenate([solid[1:], [False]])
            start &= ~(solid & (was == SPACE))
            start |= (kind == BETWEEN) | (was == BETWEEN) | (~solid & (kind != BETWEEN) & after)
        at = np.flatnonzero(start)
        end = np.append(at[1:], len(data))
        keep = kind[at] != BETWEEN if self.kind == "byte" else solid[at]
        return at[keep], end[keep]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One uint32 array per text, for a batch of a few million characters at most, or one longer text."""
        whole = {i for i, t in enumerate(texts) if self.kind == "whole" or ODD.search(t)}
        if len(texts) == 1 and len(texts[0]) > LONG and not whole:
            cuts, at = [0], LONG // 2
            while m := PLAIN_SPACE.search(texts[0], at):
                cuts.append(m.start())
                at = m.start() + LONG // 2
            parts = [texts[0][a:b] for a, b in zip(cuts, [*cuts[1:], None], strict=True)]
            if len(parts) > 1:
                return [np.concatenate([self.encode([p])[0] for p in parts])]
        raws = [b"" if i in whole else t.encode() for i, t in enumerate(texts)]
        data = np.frombuffer(b"\0" + b"\0".join(raws) + b"\0", dtype=np.uint8)
        if self.kind == "word":
            data = LOWER[data]
        at, to = self._segments(data)
        words = np.stack(span_words(data, at, to))
        while True:
            names, first, place = np.unique(hashed_words(words, self.salt), return_index=True, return_inverse=True)
            k = self._find(names)
            some = words[:, first]
            if not ((words != some[:, place]).any() or (self.words[:, k] != some)[:, k >= 0].any()):
                break
            self.salt += 1  # two pieces of one name: all get others
            self._reset()
        fresh, full, used, pieces = np.flatnonzero(k < 0), self.pieces >= MAX_PIECES, self.used, self.pieces
        if len(fresh):
            raw = data.tobytes()
            spans = zip(at[first[fresh]].tolist(), to[first[fresh]].tolist(), strict=True)
            k[fresh] = self._learn([raw[a:b].decode() for a, b in spans], some[:, fresh])
            if not full:
                self._remember(names[fresh], k[fresh])
        k = k[place]
        n = self.count[k]
        ends = np.cumsum(n, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[k] - (ends - n), n) + np.arange(total)]
        text_ends = np.cumsum([len(r) + 1 for r in raws])
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.searchsorted(at, text_ends)])].tolist()
        out = [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        for i in whole:
            out[i] = np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, dtype=np.uint32)
        if full and 2 * len(fresh) > len(names):  # other texts than those the cache was filled with
            self._reset()
        elif full:
            self.used, self.pieces = used, pieces
        return out


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file."""
    cache = worker_cache()
    if ("encoder", path) not in cache:
        cache["encoder", path] = PieceEncoder(path)
    return cache["encoder", path]


def batches_by_size(texts: list[str], limit: int = 1 << 20):
    """(from, to) ranges over ``texts`` of about ``limit`` characters; a longer text stands alone."""
    a, size = 0, 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > limit:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)
