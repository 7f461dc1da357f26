"""Vocabulary and exact merges of byte-level BPE, for many words at a time."""

import json

import numpy as np

_NONE = np.int32(2**31 - 1)


def byte_signs() -> dict[str, int]:
    """The sign by which vocabulary files write each byte: printable bytes stand for themselves,
    the others, in order, for the signs from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Merges, token bytes and special strings of a byte-level BPE file in JSON."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = (
            spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and not model.get("dropout") and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        if not plain:
            raise ValueError("only byte-level BPE without normalisation is supported")
        signs, ids = byte_signs(), model["vocab"]
        self.specials = {}
        for added in spec["added_tokens"]:
            if added["lstrip"] or added["rstrip"] or added["single_word"]:
                raise ValueError("added tokens that take in white space are not supported")
            self.specials[added["content"].encode()] = added["id"]
        self.pieces = [b""] * (1 + max([*ids.values(), *self.specials.values()]))
        for token, i in ids.items():
            self.pieces[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        for content, i in self.specials.items():
            self.pieces[i] = content
        single = {p: i for i, p in enumerate(self.pieces) if len(p) == 1}
        self.of_byte = np.array([single[bytes([b])] for b in range(256)], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.uint64)
        right = np.array([ids[b] for _, b in merges], np.uint64)
        self._fill(left << np.uint64(32) | right, np.array([ids[a + b] for a, b in merges], np.int32))

    def _fill(self, keys, merged):
        """A table with open addressing from pairs to their rank and the id they give."""
        self.bits = int(len(keys) * 4).bit_length()
        size = 1 << self.bits
        self.keys = np.full(size + 64, 2**64 - 1, np.uint64)
        self.rank, self.merged = np.full(size + 64, _NONE, np.int32), np.zeros(size + 64, np.int32)
        slots = self._slot(keys)
        for rank, (slot, key) in enumerate(zip(slots.tolist(), keys)):
            while self.keys[slot] != 2**64 - 1:
                if self.keys[slot] == key:
                    break
                slot += 1
            else:
                self.keys[slot], self.rank[slot], self.merged[slot] = key, rank, merged[rank]
        if self.keys[-1] != 2**64 - 1:
            raise ValueError("the table of pairs is too full")

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots of pairs; the rank at the slot of an unknown pair is the largest number."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots = self._slot(keys)
        held = self.keys[slots]
        open_ = np.flatnonzero((held != keys) & (held != np.uint64(2**64 - 1)))
        while len(open_):
            slots[open_] += 1
            held = self.keys[slots[open_]]
            open_ = open_[(held != keys[open_]) & (held != np.uint64(2**64 - 1))]
        return slots

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row and the bounds of each word in them.

        All words advance together: in each turn every word merges its best pair wherever it
        stands, from the left. A pair that contains a merged id ranks behind the pair that made
        it, so that merging equal pairs at once gives what merging one by one gives.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        ids = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_word = [], []
        while len(ids):
            # Rank of each id with the next one of its word.
            rank = np.full(len(ids), _NONE, np.int32)
            joint = np.flatnonzero(word[1:] == word[:-1])
            slots = self.find(ids[joint], ids[joint + 1])
            rank[joint] = self.rank[slots]
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(begins, len(ids)))
            best = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            finished = best == _NONE
            done_ids.append(ids[finished])
            done_word.append(word[finished])
            chosen = (rank == best) & ~finished
            # Of chosen places in a row, every second one overlaps the one before.
            places = np.flatnonzero(chosen)
            if not len(places):
                break
            row = np.flatnonzero(np.append(True, np.diff(places) != 1))
            offset = np.arange(len(places)) - np.repeat(row, np.diff(np.append(row, len(places))))
            places = places[offset % 2 == 0]
            slot_of = np.zeros(len(ids), np.int64)
            slot_of[joint] = slots
            ids[places] = self.merged[slot_of[places]]
            keep = ~finished
            keep[places + 1] = False
            ids, word = ids[keep], word[keep]
        ids, word = np.concatenate([*done_ids, ids[:0]]), np.concatenate([*done_word, word[:0]])
        order = np.argsort(word, kind="stable")
        return ids[order], np.searchsorted(word[order], np.arange(len(words) + 1))


class Cache:
    """Ids of words met so far in this process, encoded once; emptied when it is full."""

    def __init__(self, vocabulary: Vocabulary, most: int = 150_000):
        self.vocabulary, self.most = vocabulary, most
        self.clear()

    def clear(self):
        self.slot: dict[bytes, int] = {}
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def slots(self, words: list[bytes]) -> np.ndarray:
        """Slots of words; ids[bounds[s]:bounds[s + 1]] are the ids of slot s."""
        if len(self.slot) > self.most:
            self.clear()
        fresh = [w for w in dict.fromkeys(words) if w not in self.slot]
        if fresh:
            ids, bounds = self.vocabulary.encode(fresh)
            self.slot.update(zip(fresh, range(len(self.bounds) - 1, len(self.bounds) - 1 + len(fresh))))
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
