"""BPE encoding and decoding with a contiguous rank array per word.

The merge loop holds, for many words at once, the part boundaries of each word (as the row of its
current parts) and beside them the rank of every adjacent pair. It repeatedly scans a word's ranks
for the minimum, deletes that boundary and refreshes the two neighbouring ranks, until no pair of
the word has a rank. Words longer than ``SHORT`` bytes are merged by a heap over a linked list,
which gives the same merges without rescanning.

Text is split as the vocabulary file says: added tokens first, then NFC, white space, lower case,
and the word pattern. Words are found on arrays of code points and recognised by a 64-bit hash with
random weights per code point, so only the distinct words of a slice are handled in Python. A word
table of bounded size is kept per worker; it holds results only, so its size never changes them.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame

from statloom.llm.common import KEPT, arrow_rows, text_rows

SHORT = 48  # bytes of a word that goes through the rank arrays
KNOWN = 400_000  # words kept per worker, about 40 bytes each
RECENT = 1 << 16  # words that are merged into the large table at once
PIECE = 1 << 18  # code points handled at once
NONE = np.int32(2**31 - 1)

# ---- fixed values: white space of the pattern and its contractions ----
SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
# ---- end of fixed values ----

SPACES = re.compile("[" + "".join(map(chr, SPACE)) + "]")
LETTER, NUMBER, OTHER, NEWER = 1, 2, 3, 4
QUOTE = ord("'")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class Bpe:
    """A vocabulary file (byte-level BPE with a word-end mark) ready for encoding."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.names = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int32)
        self.final = np.array([vocab[s + end] for s in symbols], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), made  # made: by rank
        self.lookup = {int(k): int(r) for k, r in zip(key, range(len(key)))}
        # 0: white space; the other classes as in the word pattern
        kinds = np.full(0x110000, OTHER, dtype=np.uint8)
        for cp in range(0x110000):
            kind = unicodedata.category(chr(cp))
            if kind[0] in "LN":
                kinds[cp] = LETTER if kind[0] == "L" else NUMBER
            elif kind == "Cn":
                kinds[cp] = NEWER  # maybe assigned in the Unicode version of the tokenizers library
        kinds[SPACE] = 0
        self.kinds = kinds
        rng = np.random.default_rng(7)
        self.weights = rng.integers(0, 2**64, 0x110000, dtype=np.uint64)
        self.step = np.uint64(0x9E3779B97F4A7C15)
        back = np.uint64(pow(int(self.step), -1, 2**64))
        with np.errstate(over="ignore"):
            self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(PIECE * 2, self.step, dtype=np.uint64))])
            self.inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(PIECE * 2, back, dtype=np.uint64))])
        self.content = content
        self.symbol_bytes = {ord(s): b for b, s in enumerate(symbols)}
        self._forget()

    def _forget(self) -> None:
        """Start the word table anew: sorted hashes with their word numbers, and the words' ids in a row."""
        none = (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32))
        self.known = [none, none]  # many words, and those met since
        self.count = self.used = 0
        self.flat = np.empty(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 14, dtype=np.int32)
        self.sizes = np.zeros(1 << 14, dtype=np.int32)

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers of sorted hashes, -1 for words that aren't in the table."""
        rows = np.full(len(hashes), -1, dtype=np.int64)
        for table, numbers in self.known:
            if len(table):
                at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
                hit = table[at] == hashes
                rows[hit] = numbers[at[hit]]
        return rows

    # ---- words to ids ----

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of 1 to ``SHORT`` bytes, merged side by side."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)
        place = np.arange(width)
        parts = self.inner[raw]
        rows = np.arange(len(words))
        parts[rows, sizes - 1] = self.final[raw[rows, sizes - 1]]
        ranks = np.full((len(words), width), NONE, dtype=np.int32)  # of parts j and j + 1
        if width > 1:
            inside = place[None, : width - 1] < (sizes - 1)[:, None]
            r, c = np.nonzero(inside)
            ranks[r, c] = self.rank(parts[r, c], parts[r, c + 1])
        size, live = sizes.copy(), rows
        p, k = parts, ranks
        while len(live):
            best = k.argmin(axis=1)  # the leftmost of the smallest
            least = k[np.arange(len(live)), best]
            going = least != NONE
            if not going.all():
                done = ~going
                parts[live[done]] = p[done]
                size[live[done]] = sizes[live[done]]
                live, p, k, best, least = live[going], p[going], k[going], best[going], least[going]
                if not len(live):
                    break
            at = np.arange(len(live))
            p[at, best] = self.made[least]
            # delete the boundary after part `best`: what stands behind moves up
            source = np.minimum(place[None, :] + (place[None, :] > best[:, None]), width - 1)
            p = np.take_along_axis(p, source, 1)
            moved = np.minimum(place[None, :] + (place[None, :] >= best[:, None]), width - 1)
            k = np.take_along_axis(k, moved, 1)
            sizes[live] -= 1
            n = sizes[live]
            k[at, np.minimum(n - 1, width - 1)] = NONE
            k[:, width - 1] = NONE
            left = best > 0
            k[at[left], best[left] - 1] = self.rank(p[at[left], best[left] - 1], p[at[left], best[left]])
            right = best < n - 1
            k[at[right], best[right]] = self.rank(p[at[right], best[right]], p[at[right], best[right] + 1])
        return [parts[i, : size[i]].copy() for i in range(len(words))]

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same merges for a long word: a heap of (rank, place) over a linked list."""
        raw = np.frombuffer(word, dtype=np.uint8)
        part = self.inner[raw].tolist()
        part[-1] = int(self.final[raw[-1]])
        n = len(part)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n)
        lookup = self.lookup
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := lookup.get(part[i] << 32 | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or part[i] != a or part[j] != b:
                continue  # one of its parts has been merged meanwhile
            part[i] = int(self.made[rank])
            gone[j] = 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := lookup.get(part[x] << 32 | part[y])) is not None:
                    heapq.heappush(heap, (r, x, part[x], part[y]))
        return np.array([part[i] for i in range(n) if not gone[i]], dtype=np.int32)

    def merge_bytes(self, data: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(data)
        by_size = sorted(range(len(data)), key=lambda i: len(data[i]))
        short = [i for i in by_size if len(data[i]) <= SHORT]
        for at in range(0, len(short), 8192):  # words of like length share an array
            some = short[at : at + 8192]
            for i, ids in zip(some, self.merge_short([data[i] for i in some])):
                out[i] = ids
        for i in by_size[len(short) :]:
            out[i] = self.merge_long(data[i])
        return out

    # ---- text to words ----

    def normal(self, text: str) -> str:
        """NFC and lower case by code point (no final sigma)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def words(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pattern's matches."""
        kinds = self.kinds[points]
        n = len(kinds)
        first = np.ones(n, dtype=bool)
        first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
        quotes = np.flatnonzero(first & (points == QUOTE))
        if len(quotes):
            ahead = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
            one, two = ahead[quotes + 1], ahead[quotes + 2]
            for mark in CONTRACTIONS:
                hit = one == ord(mark[0])
                if len(mark) == 2:
                    hit &= two == ord(mark[1])
                at = quotes[hit]
                first[at + 1] = False
                behind = at + len(mark) + 1
                if len(mark) == 2:
                    first[at + 2] = False
                first[behind[behind < n]] = True
                one = np.where(hit, 0, one)
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        keep = kinds[starts] != 0
        return starts[keep], ends[keep]

    def _pieces(self, texts: list[str]):
        """Runs of ``(text number, text)`` of about PIECE code points; long texts are cut at white space."""
        run, total = [], 0
        for i, text in enumerate(texts):
            while len(text) > PIECE:
                cut = next((m.start() for m in SPACES.finditer(text, PIECE // 2)), len(text))
                head, text = text[:cut], text[cut:]
                if run:
                    yield run
                yield [(i, head)]
                run, total = [], 0
            run.append((i, text))
            total += len(text)
            if total >= PIECE:
                yield run
                run, total = [], 0
        if run:
            yield run

    def _hash(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = np.empty(len(starts), dtype=np.uint64)
            limit = len(self.powers) - 1
            if len(points) > limit:  # one word without white space may be longer than the tables
                for i, (s, e) in enumerate(zip(starts, ends)):
                    out[i] = np.uint64(hash(points[s:e].tobytes()) & (2**64 - 1))
                return out
            sums = np.concatenate([[np.uint64(0)], np.cumsum(self.weights[points] * self.powers[: len(points)])])
            return (sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64) * self.step

    def _run(self, run: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a run, ids per word, and the place in the run of every word."""
        joined = "\n".join(t for _, t in run)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        begin = np.cumsum([0, *[len(t) + 1 for _, t in run]])
        if len(joined) > 0 and not joined.isascii() and (self.kinds[points] == NEWER).any():
            return self._newer(run)
        starts, ends = self.words(points)
        if not len(starts):
            return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        kinds, at, back = np.unique(self._hash(points, starts, ends), return_index=True, return_inverse=True)
        if self.count + len(kinds) > KNOWN:
            self._forget()
        rows = self._numbers(kinds)
        new = np.flatnonzero(rows < 0)
        if len(new):
            made = self.merge_bytes(
                [joined[s:e].encode("utf-8", "surrogatepass") for s, e in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
            )
            rows[new] = np.arange(self.count, self.count + len(new))
            self._keep(kinds[new], made)
        word = rows[back]
        sizes = self.sizes[word].astype(np.int64)
        stops = np.cumsum(sizes)
        source = np.repeat(self.starts[word] - (stops - sizes), sizes) + np.arange(stops[-1])
        return self.flat[source], sizes, np.searchsorted(begin, starts, side="right") - 1

    def _newer(self, run: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_run`` where code points are newer than this Python's tables: the library finds the words."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.content.decode())
        words, place = [], []
        for k, (_, text) in enumerate(run):
            for word, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text)):
                words.append(bytes(word.translate(self.symbol_bytes).encode("latin-1")))
                place.append(k)
        made = self.merge_bytes(words)
        sizes = np.array([len(x) for x in made], dtype=np.int64)
        return np.concatenate([np.empty(0, dtype=np.int32), *made]), sizes, np.array(place, dtype=np.int64)

    def _keep(self, hashes: np.ndarray, made: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in made], dtype=np.int64)
        first, total = self.count, int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + len(made) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.flat[self.used : self.used + total] = np.concatenate(made)
        self.starts[first : first + len(made)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first : first + len(made)] = sizes
        self.used += total
        self.count += len(made)
        many, recent = self.known
        recent = _merged(recent, (hashes, np.arange(first, self.count, dtype=np.int32)))
        self.known = [many, recent] if len(recent[0]) < RECENT else [_merged(many, recent), (recent[0][:0], recent[1][:0])]

    # ---- texts ----

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], np.zeros(len(texts), dtype=np.int64)
        for run in self._pieces([self.normal(t) for t in texts]):
            flat, sizes, place = self._run(run)
            ids.append(flat)
            np.add.at(counts, np.array([i for i, _ in run])[place], sizes)
        return (np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)), counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in a row, and how many belong to each text."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            pieces = self.split.split(text) if self.split and any(a in text for a in self.added) else [text]
            parts += pieces
            owner += [i] * len(pieces)
        special = [self.added.get(p) if len(parts) > len(texts) else None for p in parts]
        flat, counts = self._plain(["" if s is not None else p for p, s in zip(parts, special)])
        if len(parts) > len(texts):
            stops = np.cumsum(counts)
            marks = [k for k, s in enumerate(special) if s is not None]
            flat = np.insert(flat, stops[marks], [special[k] for k in marks])
            counts[marks] += 1
            counts = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        return flat, counts

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a blank, as a file without a decoder asks."""
        names = self.names
        return " ".join([names[i] for i in ids])


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.concatenate([a[0], b[0]])
    order = np.argsort(hashes, kind="stable")
    return hashes[order], np.concatenate([a[1], b[1]])[order]


OWNER = "bpe"
_LOADED: dict[int, Bpe] = KEPT.setdefault(OWNER, {})


def loaded(content: bytes) -> Bpe:
    """The vocabulary of this worker; one is kept."""
    key = hash(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(content)
    return _LOADED[key]


def vocabulary(df: DataFrame, path: str):
    """The vocabulary file (a few MB, read once by the driver) as a broadcast value."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` for every row, with ids in text order.

    A NULL text counts as empty and has no ids; repeated rows and NULL ids give a row each; an
    empty table gives none. Columns other than the two named are left behind.
    """
    shared = vocabulary(df, path)

    def step(batch):
        flat, counts = loaded(shared.value).encode(batch.column("text").to_pylist())
        parts = np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []
        return {"doc_id": batch.column("doc_id"), "ids": parts}

    return arrow_rows(text_rows(df, id_col, text_col), "doc_id long, ids array<int>", step, "text", owner=OWNER)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts with digests of the ids and of the decoded text; see ``encode`` for odd rows."""
    import hashlib

    shared = vocabulary(df, path)

    def step(batch):
        bpe = loaded(shared.value)
        flat, counts = bpe.encode(batch.column("text").to_pylist())
        numbers = list(map(str, range(len(bpe.names))))
        out = {"doc_id": batch.column("doc_id"), "n_tokens": counts, "ids_sha256": [], "decoded_sha256": []}
        stop = 0
        for n in counts.tolist():
            ids = flat[stop : stop + n].tolist()
            stop += n
            out["ids_sha256"].append(hashlib.sha256(" ".join([numbers[i] for i in ids]).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
        return out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_rows(text_rows(df, id_col, text_col), schema, step, "text", owner=OWNER)
