"""A minimal acyclic transducer from words to numbers, walked for many words at a time.

States with equal continuations are one state, so that words share prefixes and suffixes. Each
transition carries the number of words that come before it below its state; the sum along the
path of a word is the word's place in the sorted list, which leads to its ids. The tables are
written to a file that workers map into memory.
"""

import os
import tempfile

import numpy as np


class Lexicon:
    """`words` in ascending order of bytes; number i belongs to words[i]."""

    DEAD, ROOT = 0, 1

    def __init__(self, words: list[bytes]):
        known: dict[tuple, int] = {}
        # A path of open states: [is a word, [(byte, state)]] for each byte of the last word.
        path: list[list] = [[False, []]]
        last = b""
        final, edges = [False, False], [[], []]

        def close(depth):
            while len(path) > depth + 1:
                word, out = path.pop()
                key = (word, tuple(out))
                state = known.get(key)
                if state is None:
                    state = known[key] = len(final)
                    final.append(word)
                    edges.append(out)
                path[-1][1].append((last[len(path) - 1], state))

        for word in words:
            if word <= last and (last or not word):
                raise ValueError("words must be ascending, distinct and not empty")
            shared = len(os.path.commonprefix([word, last]))
            close(shared)
            path.extend([False, []] for _ in word[shared:])
            path[-1][0] = True
            last = word
        close(0)
        edges[self.ROOT] = path[0][1]

        used = sorted({b for out in edges for b, _ in out})
        self.columns = np.zeros(256, np.int32)  # column 0 leads nowhere
        self.columns[used] = np.arange(1, len(used) + 1)
        self.next = np.zeros((len(final), len(used) + 1), np.int32)
        self.output = np.zeros_like(self.next)
        self.final = np.array(final)
        below = np.zeros(len(final), np.int64)
        # A state is numbered after all states it leads to, but for the root.
        for state in [*range(2, len(final)), self.ROOT]:
            before = int(final[state])
            for b, to in edges[state]:
                column = self.columns[b]
                self.next[state, column], self.output[state, column] = to, before
                before += below[to]
            below[state] = before
        self.longest = max(map(len, words), default=0)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of the words that stand at starts:ends of data; -1 where unknown."""
        width = self.next.shape[1]
        step, output = self.next.reshape(-1), self.output.reshape(-1)
        lengths = ends - starts
        number = np.full(len(starts), -1, np.int64)
        live = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        state = np.full(len(live), self.ROOT, np.int32)
        total = np.zeros(len(live), np.int32)
        for k in range(self.longest):
            if not len(live):
                break
            at = state * width + self.columns[data[starts[live] + k]]
            total += output[at]
            state = step[at]
            over = lengths[live] == k + 1
            ended = np.flatnonzero(over & self.final[state])
            number[live[ended]] = total[ended]
            on = np.flatnonzero(~over & (state != self.DEAD))
            live, state, total = live[on], state[on], total[on]
        return number

    def tables(self) -> dict[str, np.ndarray]:
        return {"next": self.next, "output": self.output, "final": self.final, "columns": self.columns}

    @classmethod
    def mapped(cls, tables: dict[str, np.ndarray], longest: int) -> "Lexicon":
        """The same lexicon over tables in a memory-mapped file, whose name is gone at once."""
        self = cls.__new__(cls)
        self.longest = longest
        for name, values in tables.items():
            handle, path = tempfile.mkstemp()
            try:
                with os.fdopen(handle, "wb") as file:
                    file.write(np.ascontiguousarray(values).tobytes())
                mapped = np.memmap(path, values.dtype, "r", shape=values.shape) if values.size else values
                setattr(self, name, np.asarray(mapped))
            finally:
                os.unlink(path)
        return self
