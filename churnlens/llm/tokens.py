"""Token ids of whole texts by the ``tokenizers`` library, with a bounded word cache.

A text is split into the tokenizer's own pre-tokens. BPE never merges across pre-tokens, so the ids of a
text are its pre-tokens' ids in order; these are cached, and only pre-tokens that are not in the cache
reach the library, many in one call. The split rules are those in the vocabulary files and are read from
them. They are applied to the bytes of many texts at once: ASCII characters and Latin letters by their
class; a run between white space that holds others is a piece of its own, which the rules' own pattern
splits when it is learned. Arrow finds a group's distinct pieces, so each is looked up once a group.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

_OPEN: dict[tuple, CachedEncoder] = {}

# The pre-token pattern that a ByteLevel pre-tokenizer with use_regex applies.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# The pattern of a word vocabulary's Split pre-tokenizer.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_path(name_or_path: str) -> str:
    """A file path as it is, or the place of a named file of the public tokenizers."""
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def encoder(name_or_path: str, cache_entries: int = 1_000_000) -> CachedEncoder:
    """The encoder of this Python worker for a vocabulary; opened once per worker."""
    key = (name_or_path, cache_entries)
    if key not in _OPEN:
        _OPEN[key] = CachedEncoder(vocabulary_path(name_or_path), cache_entries)
    return _OPEN[key]


class CachedEncoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes, equal to
    ``tokenizer.encode(text, add_special_tokens=False).ids``. The caches hold at most about
    ``cache_entries`` entries, half of them new: when these are full they replace the old half, from
    which words that occur again come back, so memory is bounded, frequent words are learned once and
    the ids are the same."""

    def __init__(self, path: str, cache_entries: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.cache_entries = cache_entries
        self.words: dict[bytes, bytes] = {}  # pieces in UTF-8; where spaces are kept, with the space before them
        self.old: dict[bytes, bytes] = {}  # the half of the words that were learned earlier
        self.long: dict[bytes, bytes] = {}  # long pieces of the present group
        self.added = [t["content"] for t in spec.get("added_tokens") or ()]
        normal = spec.get("normalizer") or {}
        kinds = [x["type"] for x in normal.get("normalizers", [normal] if normal else [])]
        pre = spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers", [pre])
        split = next((s for s in steps if s.get("type") == "Split"), None)
        byte = next((s for s in steps if s.get("type") == "ByteLevel"), None)
        self.keeps_space = split is None
        vocab = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        self.newline = vocab.get("\u010a", -1)  # the byte-level token of a line feed
        if (split and kinds == ["NFC", "Replace", "Lowercase"] and split["pattern"].get("Regex") == WORD_PATTERN
                and split["behavior"] == "Removed" and split["invert"]):
            self.pattern = regex.compile(WORD_PATTERN)
            end = spec["model"].get("end_of_word_suffix") or "\0"
            self.edge[[i for t, i in vocab.items() if t.endswith(end)]] = True  # ids that end a pre-token
        elif not kinds and byte and byte["use_regex"] and not byte["add_prefix_space"]:
            self.pattern = regex.compile(BYTE_LEVEL_PATTERN)
            self.edge[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # ids that begin with a space
        else:
            self.pattern = None  # unknown rules: every text goes to the library whole
        self.lower = "Lowercase" in kinds
        # letters whose lower case and composed form don't depend on their neighbours
        self.plain = re.compile("[^\x00-\u012f\u0131-\u024f]")

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _put(self, piece: bytes, ids: bytes) -> None:
        (self.words if len(piece) <= LONG_PIECE else self.long)[piece] = ids

    def _learn_parts(self, parts: list[bytes], joint: bytes) -> None:
        """Ids of pre-tokens, many in one text: where they meet shows in the ids. Where the count differs
        from the pre-tokens', each is encoded by itself."""
        gap = joint == b"\n"
        for at in range(0, len(parts), 512):
            some = parts[at:at + 512]
            text = joint.join(some).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            edges = (4 * np.flatnonzero(ids == self.newline if gap else self.edge[ids])).tolist()
            raw = ids.tobytes()
            if gap:
                first, last = [0, *(e + 4 for e in edges)], [*edges, len(raw)]
            elif self.keeps_space:
                first, last = edges, [*edges[1:], len(raw)]
            else:
                last = [e + 4 for e in edges]
                first = [0, *last[:-1]]
            if len(first) == len(last) == len(some) and first[0] == 0 and last[-1] == len(raw):
                for p, i, j in zip(some, first, last, strict=True):
                    self._put(p, raw[i:j])
            else:
                for p in some:
                    self._put(p, self._whole(p.decode()))

    def _learn(self, pieces: list[bytes]) -> None:
        """Put the ids of pieces, which are in no cache, into the caches."""
        spaced, simple, mixed = self.keeps_space, [], {}
        for p in pieces:
            if p.isascii() or not MIXED.search(p):
                simple.append(p)
            else:
                mixed[p] = [t.encode() for t in self.pattern.findall(p.decode())]
        if mixed:
            spread = {x for parts in mixed.values() for x in parts}.difference(simple, mixed)
            simple += [x for x, ids in zip(spread, self._held(list(spread)), strict=True) if ids is None]
            simple += [p for p, parts in mixed.items() if parts == [p]]
        joined, bare = [], []
        for p in simple:
            if p[-1] <= 32 and not p.strip(b" \t\n\r"):
                self._put(p, self._whole(p.decode()) if spaced else b"")
            elif not spaced:
                joined.append(p)
            elif not (p[-1] > 32 and p.isascii()) and p.decode().isspace():
                self._put(p, self._whole(p.decode()))
            elif p[0] == 32:
                joined.append(p)
            else:
                bare.append(p)
        self._learn_parts(joined, b"" if spaced else b" ")
        self._learn_parts(bare, b"\n")
        # a piece's parts are never split further, so they are known by now
        for p, parts in mixed.items():
            if parts != [p]:
                self._put(p, b"".join(self._held(parts)))

    def _held(self, pieces: list[bytes]) -> list[bytes | None]:
        """What the caches hold for each piece; words of the old half become new ones."""
        found = list(map(self.words.get, pieces))
        if None in found and (self.old or self.long):
            missing = [k for k, ids in enumerate(found) if ids is None]
            keys = [pieces[k] for k in missing]
            for k, p, ids in zip(missing, keys, map(self.old.get, keys), strict=True):
                if ids is not None:
                    found[k] = self.words[p] = ids
                elif len(p) > LONG_PIECE:
                    found[k] = self.long.get(p)
        return found

    def _all_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct pieces."""
        found = self._held(pieces)
        if None in found:
            new = [k for k, ids in enumerate(found) if ids is None]
            wanted = [pieces[k] for k in new]
            self._learn(wanted)
            for k, ids in zip(new, self._held(wanted), strict=True):
                found[k] = ids
        return found

    def _starts(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where the pieces of texts that begin at ``begins`` start."""
        kind = KINDS[data]
        if (data > 127).any():
            at = np.flatnonzero(data[:-1] == 0xC3)
            kind[at[(data[at + 1] == 0x97) | (data[at + 1] == 0xB7)]] = OTHERS  # the signs among the Latin letters
        first = np.zeros(len(data), dtype=bool)
        first[begins] = True
        start = first.copy()
        start[1:] |= kind[1:] != kind[:-1]
        if not self.keeps_space:
            start |= kind == DIGIT
        else:  # the last of some white space before others stands alone; a space there belongs to what follows
            space = kind == SPACE
            last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:])
            start[last] = True
            start[last[data[last] == 32] + 1] = False
        # 's 't 'm 'd 're 've 'll
        at = np.flatnonzero((data[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~first[1:])
        if len(at):
            one, two = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
            two = np.where((at + 2 < len(data)) & ~first[np.minimum(at + 2, len(data) - 1)], two, 0)
            short = np.isin(one, SHORT)
            long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
            start[at[short | long] + 1] = False
            after = np.concatenate([at[short] + 2, at[long] + 3])
            start[after[after < len(data)]] = True
        rare = np.flatnonzero(kind == OTHERS)
        if len(rare):
            black = kind != SPACE
            head = black & first
            head[1:] |= black[1:] & ~black[:-1]
            low = np.flatnonzero(head)
            run = np.unique(np.searchsorted(low, rare, "right") - 1)
            stop = black.copy()
            stop[:-1] &= ~black[1:] | first[1:]
            high = np.flatnonzero(stop)
            inside = np.zeros(len(data) + 1, dtype=np.int8)
            inside[low[run] + 1] += 1
            np.subtract.at(inside, high[run] + 1, 1)
            start &= np.cumsum(inside[:-1], dtype=np.int8) == 0
        return np.flatnonzero(start)

    def _group(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts without odd characters, none of them empty."""
        raw = [t.encode() for t in texts]
        ends = np.cumsum([len(r) for r in raw])
        begins = np.concatenate([[0], ends[:-1]])
        joined = b"".join(raw)
        del raw
        starts = self._starts(np.frombuffer(joined, dtype=np.uint8), begins)
        offsets = np.append(starts, len(joined)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        _, bounds, data = coded.dictionary.buffers()
        bounds, data = np.frombuffer(bounds, dtype=np.int64)[:len(coded.dictionary) + 1].tolist(), data.to_pybytes()
        ids = self._all_ids([data[i:j] for i, j in zip(bounds, bounds[1:])])  # noqa: B905  one less
        codes = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        each = sizes[codes]
        edges = np.concatenate([[0], np.cumsum(each)])
        take = np.repeat((np.cumsum(sizes) - sizes)[codes] - edges[:-1], each)
        take += np.arange(len(take))
        out = flat[take].tobytes()
        cuts = (4 * edges[np.searchsorted(starts, np.append(begins, len(joined)))]).tolist()
        return [out[i:j] for i, j in zip(cuts, cuts[1:])]  # noqa: B905  one less

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; null counts as empty."""
        out: list[bytes] = [b""] * len(texts)
        group: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if 2 * len(self.words) > self.cache_entries:
                self.old, self.words = self.words, {}
            if group:
                for (k, _), ids in zip(group, self._group([t for _, t in group]), strict=True):
                    out[k] = ids
            group.clear()
            self.long.clear()
            size = 0

        for k, text in enumerate(texts):
            if not text:
                continue
            if self.pattern is None or (self.lower and self.plain.search(text)) or any(t in text for t in self.added):
                out[k] = self._whole(text)
                continue
            if self.lower:
                text = text.lower()
            if ODD.search(text):
                flush()
                parts = [p.encode() for p in self.pattern.findall(text)]
                known = list(dict.fromkeys(parts))
                ids = dict(zip(known, self._all_ids(known), strict=True))
                out[k] = b"".join(map(ids.__getitem__, parts))
                continue
            group.append((k, text))
            size += len(text)
            if size >= GROUP:
                flush()
        flush()
        return out


#: Characters of the texts that are encoded at once.
GROUP = 4 << 20
#: Bytes of the longest pieces that are remembered.
LONG_PIECE = 128
# White space and control characters whose runs the pattern itself splits; UTF-8 of characters
# besides ASCII and Latin letters.
ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
MIXED = re.compile(rb"[\xc2\xc9-\xff]|\xc3[\x97\xb7]")
SPACE, LETTER, DIGIT, SIGN, OTHERS = range(5)
#: The kind of a byte of UTF-8; the letters from U+00C0 to U+023F have the leading bytes C3 to C8.
KINDS = np.array([SPACE if b in b" \t\n\r" else DIGIT if 48 <= b <= 57 else LETTER if chr(b).isalpha() and b < 128 or
                  128 <= b < 192 or 0xC3 <= b <= 0xC8 else OTHERS if b > 127 else SIGN for b in range(256)], dtype=np.uint8)
SHORT = np.frombuffer(b"stmd", dtype=np.uint8)


def _bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()
