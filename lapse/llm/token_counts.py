"""Token counts by compiled finite-state machines.

Two deterministic transducers make the count of a text:

* ``Cutter`` reads classes of characters and marks where pieces begin (a mark may come one
  character late: the machine has no lookahead).  A stream of texts is cut into chunks of equal
  length; all chunks run in lockstep from every state, which gives each a state map; an inclusive
  prefix scan composes the maps in O(log n) steps; a second run from the now known states marks.
* ``Counter`` reads the bytes of a piece.  A state says, for every recent position from which a
  token may still be going on, the node in the token trie, the token that ended there and how many
  tokens fewer there were.  A transition adds the number of tokens that the byte adds to the
  encoding of what was read (it may be negative), so the sum over a piece is its token count.
  Transitions are compiled when first taken and kept up to ``MAX_TRANSITIONS``.

That the last token of every prefix decides the encoding rests on a property of BPE: a sequence of
tokens is the encoding of its text exactly if every two neighbours are the encoding of theirs.

Results for odd input: null and empty texts have 0 bytes and 0 tokens; texts of any length are counted
whole, by chunks (a single piece is read from its start to its end); repeated rows give repeated results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame

from lapse.llm.bpe_codec import _source, read_vocabulary
from lapse.llm.bytebpe import Vocabulary, vocabulary
from lapse.llm.common import gathered, in_tasks, text_batches

LIMIT, CHUNK, MAX_TRANSITIONS = 512, 256, 2_000_000
# Classes of characters; the last two are the end of a text and the filling of the last chunk.
CLASSES = ("letter", "stmd", "rv", "e", "l", "number", "other", "quote", "space", "blank", "end", "fill")
# States: nothing pending; in letters, numbers, others; white space that ends in a space or in something
# else; a quote that may begin a contraction; the same after r or v, and after l.
STATES = ("start", "L", "N", "O", "space", "blank", "quote", "quote_rv", "quote_l")
BEFORE_THIS, BEFORE_LAST = 1, 2


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Tables over (state, class): the next state, and marks for this character and the one before."""
    go = np.zeros((len(STATES), len(CLASSES)), dtype=np.uint8)
    mark = np.zeros_like(go)
    s, c = {n: i for i, n in enumerate(STATES)}, {n: i for i, n in enumerate(CLASSES)}
    letters = ("letter", "stmd", "rv", "e", "l")
    kind = {**dict.fromkeys(letters, "L"), "number": "N", "other": "O", "quote": "quote", "space": "space", "blank": "blank"}
    for state in STATES:
        for name in kind:
            to, bits = kind[name], BEFORE_THIS
            if state in "LNO" and to == state or state == "O" and name == "quote":
                to, bits = state, 0
            elif state in ("space", "blank") and name in ("space", "blank"):
                bits = 0
            elif state == "space":  # the last space goes with what follows; it begins a piece
                to, bits = "O" if name == "quote" else to, BEFORE_LAST
            elif state == "blank":  # the last blank is a piece of its own
                bits = BEFORE_LAST | BEFORE_THIS
            elif state == "quote" and name in ("stmd", "rv", "l"):
                to, bits = {"stmd": "start", "rv": "quote_rv", "l": "quote_l"}[name], 0
            elif state == "quote" and name in ("other", "quote"):
                to, bits = "O", 0
            elif (state, name) in (("quote_rv", "e"), ("quote_l", "l")):
                to, bits = "start", 0
            elif state in ("quote_rv", "quote_l"):  # no contraction: the letter began a piece
                bits = BEFORE_LAST | (0 if name in letters else BEFORE_THIS)
            go[s[state], c[name]], mark[s[state], c[name]] = s[to], bits
        go[s[state], c["end"]] = s["start"]
        mark[s[state], c["end"]] = BEFORE_LAST if state in ("quote_rv", "quote_l") else 0
        go[s[state], c["fill"]] = s[state]
    return go, mark


class Cutter:
    """Finds where the pieces of a stream of texts begin."""

    def __init__(self):
        self.go, self.mark = _transitions()
        every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
        number = {n: i for i, n in enumerate(CLASSES)}
        self.class_of = np.full(0x110000, number["other"], dtype=np.uint8)
        for pattern, name in ((r"\p{L}+", "letter"), (r"\p{N}+", "number"), (r"\s+", "blank")):
            for m in regex.finditer(pattern, every):
                first, last = ord(every[m.start()]), ord(every[m.end() - 1])
                self.class_of[first:last + 1] = number[name]
        for chars, name in (("stmd", "stmd"), ("rv", "rv"), ("e", "e"), ("l", "l"), ("'", "quote"), (" ", "space")):
            self.class_of[[ord(x) for x in chars]] = number[name]
        self.end, self.fill = number["end"], number["fill"]

    def marks(self, classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """True where a piece begins; ``classes`` is the stream, with ``end`` after every text."""
        n = -(-len(classes) // chunk)
        padded = np.full(n * chunk, self.fill, dtype=np.uint8)
        padded[:len(classes)] = classes
        steps = np.ascontiguousarray(padded.reshape(n, chunk).T)
        width = self.go.shape[1]
        go, mark = (self.go.astype(np.int16) * width).ravel(), self.mark.ravel()
        # State maps: every chunk from every state (a state is kept as its row's offset).
        maps = np.tile(np.arange(len(STATES), dtype=np.int16) * width, (n, 1))
        for row in steps:
            maps = go[maps + row[:, None]]
        entry = np.zeros(n, dtype=np.int16)
        entry[1:] = scan(maps // width)[:-1, 0] * width
        out = np.empty_like(steps)
        for t, row in enumerate(steps):
            at = entry + row
            out[t] = mark[at]
            entry = go[at]
        bits = out.T.reshape(-1)[:len(classes)]
        begins = (bits & BEFORE_THIS) != 0
        begins[:-1] |= (bits[1:] & BEFORE_LAST) != 0
        return begins


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (one per row): row i becomes map i after ... after map 0."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step].astype(np.int64), axis=1)
        step *= 2
    return out


class Counter:
    """The token counting machine of one vocabulary, compiled as it runs."""

    def __init__(self, vocab: Vocabulary, max_transitions: int = MAX_TRANSITIONS):
        self.vocab, self.limit = vocab, max_transitions
        self.child: dict[int, int] = {}  # node * 256 + byte -> node; the root is 0
        self.token: dict[int, int] = {}
        nodes, inner = 1, set()
        for i in {*vocab.byte_id.tolist(), *vocab.merges[:, 2].tolist()}:
            node = 0
            for b in vocab.bytes[i]:
                inner.add(node)
                at = node * 256 + b
                if at not in self.child:
                    self.child[at] = nodes
                    nodes += 1
                node = self.child[at]
            self.token[node] = i
        self.inner = inner  # nodes that a token can go on from
        self._fits: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        first = ((0, -1, 0),)
        self.states, self.number = [first], {first: 0}
        self.edges: dict[int, tuple[int, int]] = {}

    def plain(self, text: bytes) -> list[int]:
        """The encoding of a short byte string, merge by merge."""
        out, rank, merges = [int(self.vocab.byte_id[b]) for b in text], self.vocab.rank, self.vocab.merges
        while True:
            found = [(rank[p], i) for i, p in enumerate(zip(out, out[1:])) if p in rank]
            if not found:
                return out
            r, i = min(found)
            out[i:i + 2] = [int(merges[r, 2])]

    def fits(self, last: int, token: int) -> bool:
        """Whether ``token`` right after ``last`` (-1: the beginning) is how BPE encodes the two."""
        key = (last, token)
        if key not in self._fits:
            before = [last] if last >= 0 else []
            self._fits[key] = self.plain(b"".join(self.vocab.bytes[t] for t in [*before, token])) == [*before, token]
        return self._fits[key]

    def _compile(self, edge: int) -> tuple[int, int]:
        """The transition of a state on a byte (edge: state * 256 + byte): the next state and the tokens it adds."""
        items, byte = self.states[edge >> 8], edge & 255
        going, ended, added = [], None, None
        for node, last, more in items:
            node = self.child.get(node * 256 + byte)
            if node is None:
                continue
            token = self.token.get(node)
            if ended is None and token is not None and self.fits(last, token):
                ended, added = token, more + 1
            if node in self.inner:
                going.append((node, last, more))
        state = (*((node, last, more - added) for node, last, more in going), (0, ended, 0))
        number = self.number.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        self.edges[edge] = found = (number << 8, added)
        return found

    def count(self, pieces: list[bytes]) -> np.ndarray:
        out = np.empty(len(pieces), dtype=np.int64)
        for i, piece in enumerate(pieces):
            if len(self.edges) > self.limit:
                self._forget()
                self._fits.clear()
            edges, state, total = self.edges, 0, 0
            for byte in piece:
                edge = edges.get(state + byte)
                if edge is None:
                    edge = self._compile(state + byte)
                state = edge[0]
                total += edge[1]
            out[i] = total
        return out


class TokenCounter:
    """Counts the tokens of lists of texts."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.cutter, self.counter = vocab, Cutter(), Counter(vocab)

    def __call__(self, texts: list[str]) -> np.ndarray:
        import pyarrow as pa
        special = self.vocab.special_cut
        parts, owner = [], []
        total = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            own = special.split(text) if special and any(s in text for s in self.vocab.special) else [text]
            total[i] = len(own) // 2  # a special token is one token
            parts += own[::2]
            owner += [i] * len(own[::2])
        # The stream: every part, then one character in whose place the class "end" is put.
        stream = "\0".join(parts) + "\0"
        point = np.frombuffer(stream.encode("utf-32-le"), dtype="<u4")
        classes = self.cutter.class_of[point]
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
        classes[ends] = self.cutter.end
        begins = self.cutter.marks(classes)
        begins[ends] = True
        first = np.flatnonzero(begins)
        width = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
        offset = np.concatenate((np.cumsum(width)[first] - width[first], [width.sum()]))
        data = stream.encode()
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offset), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        each = self.counter.count(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        each[classes[first] == self.cutter.end] = 0
        sums = np.concatenate(([0], np.cumsum(each)))[np.searchsorted(first, ends)]
        np.add.at(total, np.array(owner, dtype=np.int64), np.diff(np.concatenate(([0], sums))))
        return total


_COUNTERS: dict[int, TokenCounter] = {}


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_path: str | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens) of every text."""
    source, id_type = _source(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocab_path))

    def run(batches):
        import pyarrow as pa
        key = hash(sent.value)
        if key not in _COUNTERS:  # the machine stays compiled between the tasks of a worker
            _COUNTERS.clear()
            _COUNTERS[key] = TokenCounter(vocabulary(sent.value))
        for group, texts in text_batches(batches):
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [gathered(group, "id"), pa.array(sizes, type=pa.int64()), pa.array(_COUNTERS[key](texts))],
                names=["id", "n_bytes", "n_tokens"])

    return in_tasks(source, run, f"id {id_type}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


def token_counts(docs: DataFrame, vocab_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Counts with ``over_limit``."""
    counts = count_tokens(docs, vocab_path=vocab_path)
    return counts.withColumn("over_limit", counts["n_tokens"] > limit)
