"""Byte-level BPE: vocabulary, pre-tokenisation, and encoding by batched merge rounds."""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import regex

from registry_spark.llm.tasks import Numbers, ragged, segments

# Fixed value: the pattern that cuts a text before byte-level merges.
PRETOKEN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

# White space and what follows it up to the next white space; white space at the end.
PART = regex.compile(r"\s*\S+|\s+")

# Marks that end a word; they are no letters, digits, white space or part of a special string's end.
MARKS = b".,;:!?"

NO_MERGE = np.int32(2**31 - 1)
LONG_WORD = 1_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable in Latin-1, else counted on from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of a byte-level BPE tokenizer file (JSON): merges, bytes of every id, special strings."""

    def __init__(self, text: str):
        data = json.loads(text)
        kinds = (data.get("pre_tokenizer") or {}).get("type"), (data.get("decoder") or {}).get("type")
        if data["model"]["type"] != "BPE" or kinds != ("ByteLevel", "ByteLevel") or data.get("normalizer"):
            raise ValueError("not a byte-level BPE tokenizer without a normalizer")
        alphabet = byte_alphabet()
        ids = data["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in data.get("added_tokens", [])}
        size = max([*ids.values(), *self.special.values()]) + 1
        if any(t.split() != [t] for t in self.special):
            raise ValueError("special strings with white space are not supported")
        self.bytes_of = [b""] * size
        for token, i in ids.items():
            if token.encode() not in self.special:
                self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token
        self.first = np.zeros(256, np.int32)
        for c, b in alphabet.items():
            self.first[b] = ids[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.size = size
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.cut_special = regex.compile(b"(" + b"|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + b")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, by binary search over the sorted pair keys."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_MERGE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words at once: flat ids, and the number of ids of each word.

        All symbols lie in one flat array. A round merges, in every word, all places of
        its pair of lowest rank (left to right where places overlap); only the pairs
        beside a merge are looked up anew. Words without a mergeable pair leave.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        rank = np.full(len(symbols), NO_MERGE, np.int32)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self.rank(symbols[inside], symbols[inside + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            ended = best == NO_MERGE
            if ended.any():
                out = np.repeat(ended, lengths)
                done_symbols.append(symbols[out])
                done_words.append(word[out])
                symbols, word, rank = symbols[~out], word[~out], rank[~out]
                best, lengths = best[~ended], lengths[~ended]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            follows = np.concatenate(([False], at[1:] == at[:-1] + 1))
            if follows.any():
                # Overlapping places, as in a run of one letter: every second one, from the left.
                run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            now = at - np.arange(len(at))
            beside = np.zeros(len(symbols), bool)
            beside[now] = True
            beside[now[now > 0] - 1] = True
            touched = np.flatnonzero(beside)
            rank[touched] = NO_MERGE
            inside = touched[touched + 1 < len(symbols)]
            inside = inside[word[inside] == word[inside + 1]]
            rank[inside] = self.rank(symbols[inside], symbols[inside + 1])
        if not done_words:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(word, minlength=len(words))

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: a queue of pairs by rank and place over a linked list of symbols."""
        symbols = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(symbols)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        known = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        rank = lambda i, j: known.get(symbols[i] * self.size + symbols[j], -1)
        queue = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank(i, i + 1)) >= 0]
        heapq.heapify(queue)
        while queue:
            r, i, left, right = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (q := rank(a, b)) >= 0:
                    heapq.heappush(queue, (q, a, symbols[a], symbols[b]))
        return np.array([s for s in symbols if s >= 0], np.int32)

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many chunks of text, each cut into special strings and pre-tokens first."""
        words: dict[bytes, int] = {}
        plan: list[int] = []  # a word's number, or -1 - id of a special string
        counts = np.zeros(len(chunks), np.int64)
        for k, chunk in enumerate(chunks):
            before = len(plan)
            for part in self.cut_special.split(chunk) if self.cut_special else [chunk]:
                if part in self.special:
                    plan.append(-1 - self.special[part])
                elif part:
                    plan.extend(words.setdefault(w.encode(), len(words)) for w in PRETOKEN.findall(part.decode()))
            counts[k] = len(plan) - before
        texts = list(words)
        flat, sizes = self.merge([w if len(w) <= LONG_WORD else b"" for w in texts])
        long = [i for i, w in enumerate(texts) if len(w) > LONG_WORD]
        starts = segments(sizes)[:-1]
        tail = [flat, *(self.merge_long(texts[i]) for i in long)]
        end = len(flat)
        for i, ids in zip(long, tail[1:]):
            starts[i], sizes[i], end = end, len(ids), end + len(ids)
        special = sorted(self.special.values())
        tail.append(np.array(special, np.int32))
        flat = np.concatenate(tail)
        place = np.array(plan, np.int64)
        if special:
            where = np.searchsorted(special, -1 - place)
            starts = np.append(starts, end + np.arange(len(special)))
            sizes = np.append(sizes, np.ones(len(special), np.int64))
            place = np.where(place < 0, len(texts) + where, place)
        ids = flat[ragged(starts[place], sizes[place])]
        bounds = segments(sizes[place])
        cuts = segments(counts)
        return ids, bounds[cuts[1:]] - bounds[cuts[:-1]]

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of ids, special strings included; invalid UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Encoder:
    """Encodes whole texts, encoding every distinct piece between blanks once.

    A blank or line break between two characters that are no white space always starts a
    pre-token, so a text may be cut before each. Pieces are kept, with their ids, up to
    ``capacity``; then the table starts anew. A text with other white space at such a
    place is cut by the full pattern instead. ``encode_chunks`` gives the ids of new pieces.
    """

    def __init__(self, encode_chunks, capacity: int = 700_000):
        self.encode_chunks, self.capacity = encode_chunks, capacity
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        self.ids = np.zeros(1 << 16, np.int32)
        self.end = 0
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)  # -1: not to be cut here

    @staticmethod
    def chunk(piece: bytes) -> bytes | None:
        """The text of a piece; None where its ends are white space. A leading blank marks text as it is."""
        if piece[:1] == b" ":
            return piece[1:]
        text = piece.decode()
        body = text[1:] if text[:1] == "\n" else text
        if not body or body[0].isspace() or body[-1].isspace():
            return None
        return piece if text[0] == "\n" else b" " + piece

    @staticmethod
    def parts(piece: bytes) -> list[bytes]:
        """A piece cut once more where a pre-token surely starts: after a leading line break, before closing marks."""
        before = [b" \n"] if piece[:1] == b"\n" else []
        body = b" " + piece[1:] if before else piece
        core = body.rstrip(MARKS)
        if core != body and core[-1:].isalnum():
            return [*before, core, b" " + body[len(core) :]]
        return [*before, body]

    def learn(self) -> None:
        """Ids of the pieces met since the last call; pieces made of known parts need no encoding."""
        base, pieces, plans = len(self.starts), [], []
        numbers = self.numbers
        while new := numbers.new():
            pieces += new
            for piece in new:
                first, last = (piece[0], piece[-1]) if piece else (0, 0)
                if 32 < first < 127 and 32 < last < 127:
                    # The common case: ASCII characters at both ends, after a blank.
                    if last in MARKS and (core := piece.rstrip(MARKS))[-1:].isalnum():
                        plans.append([numbers[core], numbers[b" " + piece[len(core) :]]])
                    else:
                        plans.append(b" " + piece)
                    continue
                text = self.chunk(piece)
                parts = self.parts(piece) if text else []
                plans.append(text if len(parts) < 2 else [numbers[part] for part in parts])
        if not pieces:
            return
        whole = [k for k, plan in enumerate(plans) if isinstance(plan, bytes)]
        made = [k for k, plan in enumerate(plans) if isinstance(plan, list)]
        self.starts = np.concatenate((self.starts, np.zeros(len(pieces), np.int64)))
        self.sizes = np.concatenate((self.sizes, np.full(len(pieces), -1, np.int64)))
        ids, sizes = self.encode_chunks([plans[k] for k in whole])
        self.keep(base + np.array(whole, np.int64), ids, sizes)
        if made:
            numbers = np.array([n for k in made for n in plans[k]], np.int64)
            owners = np.repeat(np.arange(len(made)), [len(plans[k]) for k in made])
            sizes = self.sizes[numbers]
            self.keep(base + np.array(made, np.int64), self.ids[ragged(self.starts[numbers], sizes)], np.bincount(owners, sizes).astype(np.int64))

    def keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if self.end + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.end], np.zeros(self.end + 2 * len(ids), np.int32)))
        self.ids[self.end : self.end + len(ids)] = ids
        self.starts[numbers] = self.end + segments(sizes)[:-1]
        self.sizes[numbers] = sizes
        self.end += len(ids)

    def full_cut(self, text: bytes) -> np.ndarray:
        """Piece numbers of a text cut after every non-space character that white space follows."""
        return self.numbers.of([b" " + part.encode() for part in PART.findall(text.decode())])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each."""
        if len(self.numbers) > self.capacity:
            self.clear()
        found: list[np.ndarray] = []
        for text in texts:
            pieces = text.replace(b"\n", b" \n").split(b" ")
            first = pieces[0]
            if first and (len(pieces) == 1 or not first.decode()[-1].isspace()):
                pieces[0] = b" " + first
                found.append(self.numbers.of(pieces))
            else:
                found.append(np.full(1 if text else 0, -1))
        self.learn()
        odd = [i for i, n in enumerate(found) if len(n) and (n[0] < 0 or (self.sizes[n] < 0).any())]
        for i in odd:
            found[i] = self.full_cut(texts[i])
        self.learn()
        numbers = np.concatenate(found) if found else np.zeros(0, np.int64)
        sizes = self.sizes[numbers]
        bounds = segments(sizes)
        cuts = segments(np.fromiter(map(len, found), np.int64, len(found)))
        return self.ids[ragged(self.starts[numbers], sizes)], bounds[cuts[1:]] - bounds[cuts[:-1]]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
