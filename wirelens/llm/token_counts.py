"""Token counts of whole texts from two deterministic transducers that are compiled from a tokenizer file.

The splitter reads characters and marks where words begin. The merger reads a word's bytes; each of its transitions says
by how much the number of tokens of what was read so far changes, so a word's count is the sum over its path.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.tokens import byte_of

TOKENIZER = "byte_bpe_50k.json"
MOST_TOKENS = 512
#: Texts are counted in slices of about this many characters; the merger reads blocks of about this many bytes.
SLICE_CHARS, BLOCK_BYTES = 2_000_000, 500_000
#: Characters of a chunk of the splitter, and at its end those that usually tell its last state.
CHUNK, TAIL = 256, 16
#: Longer words are read one byte after another, with a look at the number of transitions every so many bytes.
LONG_WORD, LOOK = 512, 65536
#: Transitions that a worker remembers; beyond, it forgets all between two blocks and compiles anew what it meets.
MOST_TRANSITIONS = 1 << 19

END = 0x110000
#: Classes of characters, and symbols, which are classes with what stands behind: an apostrophe that begins a contraction
#: of one or two letters, the last blank before a word (``_LAST``) or a blank elsewhere (``_RUN``).
LETTER, NUMBER, OTHER, BLANK, SPACE, STOP, UNKNOWN = range(7)
S_LETTER, S_NUMBER, S_OTHER, S_ONE, S_TWO, S_BLANK_LAST, S_BLANK_RUN, S_SPACE_LAST, S_SPACE_RUN, S_STOP = range(10)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ON_BLANK, ON_SPACE, ONE_LEFT, TWO_LEFT = range(8)
STATES, SYMBOLS = 8, 16


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a word begins before the character, at ``state * SYMBOLS + symbol``."""
    after, begins = np.zeros(STATES * SYMBOLS, np.uint8), np.zeros(STATES * SYMBOLS, np.uint8)

    def rule(state: int, symbol: int, to: int, word: bool) -> None:
        after[state * SYMBOLS + symbol], begins[state * SYMBOLS + symbol] = to, word

    for state in range(STATES):
        for symbol, run in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS)):
            rule(state, symbol, run, state not in (run, ON_BLANK))
        for symbol, left in ((S_ONE, ONE_LEFT), (S_TWO, TWO_LEFT)):
            inside = state in (IN_OTHERS, ON_BLANK)
            rule(state, symbol, IN_OTHERS if inside else left, not inside)
        rule(state, S_BLANK_LAST, ON_BLANK, True)
        rule(state, S_SPACE_LAST, ON_SPACE, True)
        for symbol in (S_BLANK_RUN, S_SPACE_RUN):
            rule(state, symbol, ON_SPACE, state != ON_SPACE)
        rule(state, S_STOP, START, True)
    rule(TWO_LEFT, S_LETTER, ONE_LEFT, False)
    rule(ONE_LEFT, S_LETTER, START, False)
    return after, begins


AFTER, BEGINS = _splitter()


def _final_states(symbols: np.ndarray) -> np.ndarray:
    """The map of each chunk (a column of ``symbols``) from every state before it to the state after it."""

    def run(part: np.ndarray) -> np.ndarray:
        states = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], part.shape[1], axis=1)
        for row in part:
            states = AFTER.take(states.astype(np.int16) * SYMBOLS + row)
        return states

    maps = run(symbols[-TAIL:])
    open_ = np.flatnonzero((maps != maps[0]).any(axis=0))
    if len(open_):  # the tail doesn't tell, so the whole chunk is read
        maps[:, open_] = run(symbols[:, open_])
    return maps


def word_starts(symbols: np.ndarray) -> np.ndarray:
    """Whether a word begins before each symbol.

    Chunks are read side by side. Their state maps, composed by a parallel prefix scan, give the state before each one.
    """
    n = len(symbols)
    padded = np.full(-(-n // CHUNK) * CHUNK, S_STOP, np.uint8)
    padded[:n] = symbols
    chunks = np.ascontiguousarray(padded.reshape(-1, CHUNK).T)
    maps, step = _final_states(chunks), 1
    while step < maps.shape[1]:
        maps[:, step:] = np.take_along_axis(maps[:, step:], maps[:, :-step].astype(np.int64), axis=0)
        step *= 2
    state = np.concatenate([[START], maps[START, :-1]]).astype(np.int16)
    out = np.empty(chunks.shape, np.uint8)
    for k, row in enumerate(chunks):
        at = state * SYMBOLS + row
        out[k] = BEGINS.take(at)
        state = AFTER.take(at).astype(np.int16)
    return out.T.ravel()[:n].astype(bool)


class Merger:
    """The byte-pair merges as a transducer over bytes, of which states and transitions are compiled when they are met.

    The last token of a prefix is the only suffix of it that is a token and stays one behind the last token of what stands
    before. So all that what follows can depend on is, for each suffix that begins some longer token (the empty one
    among them), the token before it and by how many tokens the count there falls short of the count here: that is
    a state. A transition finds the new last token among the suffixes and says how the count changes.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.ranks = ranks
        self.merged = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.begin = {token[:k]: token[:k] for token in ranks for k in range(1, len(token))}
        self.forget()

    def forget(self) -> None:
        self.states = {((b"", None, 0),): 0}
        self.facts = [((b"", None, 0),)]
        self.stay: dict[tuple[bytes, bytes], bool] = {}
        self.path: dict[int, int] = {}
        self._make_table(1 << 16)

    def _make_table(self, slots: int) -> None:
        self.bits = slots.bit_length() - 1
        self.keys, self.values = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)

    def _stays(self, before: bytes | None, token: bytes) -> bool:
        """Whether no merge crosses the border between two tokens."""
        if before is None:
            return True
        found = self.stay.get((before, token))
        if found is None:
            found = self.stay[before, token] = list(self.merged(before + token)) == [self.ranks[before], self.ranks[token]]
        return found

    def step(self, key: int) -> int:
        """``next state << 8 | change of the count + 128`` for ``state << 8 | byte``."""
        found = self.path.get(key)
        if found is None:
            byte = bytes([key & 255])
            facts = [(suffix + byte, before, short) for suffix, before, short in self.facts[key >> 8]]
            token, change = next((s, short + 1) for s, before, short in facts if s in self.ranks and self._stays(before, s))
            new = (*((self.begin[s], before, short - change) for s, before, short in facts if s in self.begin), (b"", token, 0))
            to = self.states.setdefault(new, len(self.facts))
            if to == len(self.facts):
                self.facts.append(new)
            found = self.path[key] = to << 8 | change + 128
        return found

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _compile(self, keys: np.ndarray) -> None:
        """Transitions that the table lacks."""
        for key in np.unique(keys).tolist():
            self.step(key)
        if 2 * len(self.path) > len(self.keys):
            while 2 * len(self.path) > (1 << self.bits):
                self.bits += 1
            self._make_table(2 << self.bits)
            keys = np.fromiter(self.path, np.int64, len(self.path))
        left = np.unique(keys)
        slots = self._slots(left)
        while len(left):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = left[free]  # of several keys for a slot the last one has it
            held = self.keys[slots] == left
            self.values[slots[held]] = list(map(self.path.__getitem__, left[held].tolist()))
            left, slots = left[~held], (slots[~held] + 1) & (len(self.keys) - 1)

    def _found(self, keys: np.ndarray) -> np.ndarray:
        """The packed transition of each key, or -1."""
        slots = self._slots(keys)
        held = self.keys.take(slots)
        out = self.values.take(slots)
        left = np.flatnonzero(held != keys)
        if len(left):
            out[left[held[left] < 0]] = -1
            left = left[held[left] >= 0]
            slots = slots[left]
            while len(left):
                slots = (slots + 1) & (len(self.keys) - 1)
                held = self.keys[slots]
                out[left] = np.where(held == keys[left], self.values[slots], -1)
                more = (held != keys[left]) & (held >= 0)
                left, slots = left[more], slots[more]
        return out

    def _long(self, word: bytes) -> int:
        state = count = 0
        for at, byte in enumerate(word):
            found = self.step(state << 8 | byte)
            state, count = found >> 8, count + (found & 255) - 128
            if at % LOOK == 0 and len(self.path) > MOST_TRANSITIONS:
                facts = self.facts[state]
                self.forget()
                state = self.states.setdefault(facts, len(self.facts))
                if state == len(self.facts):
                    self.facts.append(facts)
        return count

    def counts(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each word ``data[start : start + length]``; words are read side by side, byte after byte."""
        out = np.zeros(len(start), np.int64)
        for k in np.flatnonzero(length > LONG_WORD).tolist():
            out[k] = self._long(data[start[k] : start[k] + length[k]].tobytes())
        short = np.flatnonzero(length <= LONG_WORD)
        blocks = np.cumsum(length[short]) // BLOCK_BYTES
        edges = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1, [len(short)]])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if len(self.path) > MOST_TRANSITIONS:
                self.forget()
            block = short[a:b]
            order = block[np.argsort(-length[block].astype(np.int16), kind="stable")]
            sizes, at = length[order], start[order].copy()
            left = len(order) - np.searchsorted(sizes[::-1], np.arange(LONG_WORD), side="right")  # words longer than k
            state, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
            for n in left[left > 0].tolist():
                keys = (state[:n] << 8) | data.take(at[:n])
                found = self._found(keys)
                if (missing := found < 0).any():
                    self._compile(keys[missing])
                    found[missing] = self._found(keys[missing])
                state[:n] = found >> 8
                count[:n] += (found & 255) - 128
                at[:n] += 1
            out[order] = count
        return out


class Counter:
    """Numbers of tokens, equal to those of a byte-level BPE file with the usual splitting pattern."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, pre, added = said["model"], said.get("pre_tokenizer") or {}, said.get("added_tokens", [])
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        usual = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not said.get("normalizer")
        if not (plain and usual and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)):
            raise ValueError(f"{path} isn't a plain byte-level BPE file")
        names, bytes_ = {t["content"] for t in added}, byte_of()
        ranks = {bytes(map(bytes_.__getitem__, token)): i for token, i in model["vocab"].items() if token not in names}
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [model["vocab"][t] for t in joined] != sorted(model["vocab"][t] for t in joined):
            raise ValueError(f"the ids of {path} don't follow its merges")
        self.merger = Merger(ranks)
        # the longest string first, as the library takes the longest of those that begin at a place
        self.added = re.compile("|".join(map(re.escape, sorted(names, key=len, reverse=True)))) if names else None
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.classes = np.full(END + 1, UNKNOWN, np.uint8)
        self.classes[END] = STOP
        self.classes[ord(" ")] = BLANK

    def _learn(self, codes: np.ndarray) -> None:
        """Classes of characters not met before, as the file's own splitting has them."""
        for code in np.unique(codes).tolist():
            char = chr(code)
            joins = [k for k, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.pieces(before + char)) == 1]
            self.classes[code] = joins[0] if joins else SPACE

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of characters; ``END`` ends each text."""
        kinds = self.classes.take(codes)
        if (new := kinds == UNKNOWN).any():
            self._learn(codes[new])
            kinds = self.classes.take(codes)
        behind = np.append(kinds[1:], STOP)
        last = behind < BLANK
        out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_BLANK_RUN, S_SPACE_RUN, S_STOP], np.uint8).take(kinds)
        out[last & (kinds == BLANK)] = S_BLANK_LAST
        out[last & (kinds == SPACE)] = S_SPACE_LAST
        marks = np.flatnonzero(codes == ord("'"))
        if len(marks):
            ahead = [np.append(codes, [END, END])[marks + k] for k in (1, 2)]
            out[marks[np.isin(ahead[0], [ord(c) for c in "stmd"])]] = S_ONE
            two = np.zeros(len(marks), bool)
            for a, b in ("re", "ve", "ll"):
                two |= (ahead[0] == ord(a)) & (ahead[1] == ord(b))
            out[marks[two]] = S_TWO
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        parts, owner, whole = [], [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            found = self.added.split(text) if self.added and self.added.search(text) else [text]
            whole[k] = len(found) - 1
            parts += found
            owner += [k] * len(found)
        codes = np.frombuffer(b"".join(x for part in parts for x in (part.encode("utf-32-le"), b"\x00\x00\x11\x00")), "<u4")
        data = np.frombuffer(b"".join(x for part in parts for x in (part.encode(), b"\x00")), np.uint8)
        if not len(codes):
            return whole
        begins = np.flatnonzero(word_starts(self.symbols(codes)))
        stop = codes == END
        width = np.where(stop, 1, 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000))
        place = np.concatenate([[0], np.cumsum(width)])
        edge = place[begins]
        length = np.diff(np.append(edge, place[-1]))
        real = ~stop[begins]
        start, length = edge[real], length[real]
        own = np.asarray(owner)[(np.cumsum(stop) - stop)[begins[real]]]
        return whole + np.bincount(own, self.merger.counts(data, start, length), len(texts)).astype(np.int64)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One for each worker and file."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = MOST_TOKENS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each document's whole text; a map over the rows, without a shuffle.

    Both transducers are compiled in each worker from the file at ``tokenizer``, which all machines have. A slice of texts
    is one row of characters to the splitter, cut into chunks anywhere; a text longer than a slice is a slice of its own.

    Cases: a null text is an empty one, with no token. The string of an added token is that token, as the library has it
    unless told otherwise. Repeated rows and rows with one or no doc_id are counted each. Other columns aren't read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, chars, first = [], 0, at
                while at < batch.num_rows and chars < SLICE_CHARS:
                    texts.append(batch.column(1)[at].as_py() or "")
                    chars += len(texts[-1]) + 1
                    at += 1
                n = counter(tokenizer).counts(texts)
                sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at - first), sizes, pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    return token_counts(docs, public_tokenizers.path(TOKENIZER))
