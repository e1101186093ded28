"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus is counted for its most frequent words. They are compiled into a minimal automaton: states with
equal futures are shared, and every arc adds a number, so that the numbers on a word's path sum to its place
in the table of token ids. One task compiles it; its file lies in the shared folder, goes to every executor, is
memory-mapped there, and is walked for all new words of a slice at once. A word that it lacks is merged rule by rule, exactly as the
tokenizer does. The lexicon decides about speed alone, never about the result.

A null text is empty: no tokens, and the digest of an empty string. Texts are encoded in full, however long.
Repeated rows are encoded alike; an empty table gives an empty result; columns beyond the named ones are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import in_one_task, materialise, most_frequent, put_file, slices

#: Words of the lexicon, and how many words a worker remembers or counts at a time.
LEXICON_WORDS, MEMO_WORDS, COUNT_WORDS = 300_000, 200_000, 300_000
MAX_LEXICON_CHARS = 40
LONG_WORD = 64  # bytes, above which a piece is merged alone
#: White space as the tokenizer's patterns know it.
_SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
#: A dot or comma between a letter or digit and white space is a piece of its own in the tokenizer's split.
_CLOSING = re.compile(r"([.,])(?<=[a-z0-9][.,])(?=[ \n]|\Z)")
PYTHON_ONLY = re.compile(r"[\x1c-\x1f]")  # str.split() takes these for white space, too


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself if it has one, else one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Normalisation, word split and merges of a tokenizer file with word-end marks."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()

    @staticmethod
    def normal(text: str) -> str:
        """NFC and lower case, letter by letter (no rule for a final sigma)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def spaced(self, text: str) -> str:
        """The normal text with closing dots and commas set apart."""
        return _CLOSING.sub(r" \1", self.normal(text))

    def words(self, text: str) -> list[str]:
        """Pieces between white space; no token reaches over one."""
        text = self.spaced(text)
        if not PYTHON_ONLY.search(text):
            return text.split()
        return [w for w in _SPACE.split(text) if w]

    def merge(self, piece: str) -> list[int]:
        """Token ids of one piece; the pair of the lowest rank, and of those the leftmost, comes off a heap, so a long piece takes n log n."""
        parts: list[str | None] = [self.letters[b] for b in piece.encode("utf-8", "replace")]
        parts[-1] += self.end
        rank, n = self.rank, len(parts)
        behind, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank.get((a, b))) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = behind[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j], behind[i] = a + b, None, behind[j]
            if behind[j] < n:
                before[behind[j]] = i
            for x, y in ((before[i], i), (i, behind[i])):
                if x >= 0 and y < n and (r := rank.get((parts[x], parts[y]))) is not None:
                    heappush(heap, (r, x, parts[x], parts[y]))
        return [self.vocab[x] for x in parts if x in self.vocab]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted pairs (first id << 20 | second id) with rank and merged id, and the ids of each byte inside and at the end."""
        if not hasattr(self, "_tables"):
            pairs = [(self.vocab[a] << 20 | self.vocab[b], r, self.vocab[a + b]) for (a, b), r in self.rank.items()]
            key, rank, made = (np.array(x, np.int64) for x in zip(*sorted(pairs), strict=True))
            ends = np.array([[self.vocab[x] for x in self.letters], [self.vocab[x + self.end] for x in self.letters]], np.int64)
            self._tables = (key, rank.astype(np.int32), made[np.argsort(rank)], ends)
        return self._tables

    def merge_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words on end, and n + 1 offsets: :func:`merge` of many words at once.

        Each round merges the best pair of every word that has one; words that have none leave. A piece of over
        LONG_WORD bytes goes alone.
        """
        coded = [w.encode("utf-8", "replace") for w in words]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        long = {int(k): np.array(self.merge(words[k]), np.int64) for k in np.flatnonzero(size > LONG_WORD)}
        todo = np.flatnonzero((size > 0) & (size <= LONG_WORD))
        key, rank, made, ends = self.tables()
        far = np.int32(1 << 30)

        def ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            k = left << 20 | right
            at = np.minimum(np.searchsorted(key, k), len(key) - 1)
            return np.where(key[at] == k, rank[at], far)

        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, their numbers of tokens, tokens
        n = size[todo]
        flat = np.frombuffer(b"".join([coded[k] for k in todo]), np.uint8)
        last = np.cumsum(n) - 1
        ids = ends[0][flat]
        ids[last] = ends[1][flat[last]]
        best = np.full(len(ids), far, np.int32)  # of a token with the next one
        if len(ids) > 1:
            best[:-1] = ranks(ids[:-1], ids[1:])
        best[last] = far
        while len(todo):
            first = np.cumsum(n) - n
            low = np.minimum.reduceat(best, first)
            over = low >= far
            if over.any():
                gone = np.repeat(over, n)
                done.append((todo[over], n[over], ids[gone]))
                todo, n, low, ids, best = todo[~over], n[~over], low[~over], ids[~gone], best[~gone]
                if not len(todo):
                    break
                first = np.cumsum(n) - n
            hits = np.flatnonzero(best == np.repeat(low, n))
            own = np.searchsorted(first, hits, "right") - 1
            at = hits[np.concatenate([[True], own[1:] != own[:-1]])]  # the leftmost of each word
            ids[at] = made[low]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            to = at - np.arange(len(at))  # where the merged tokens lie once one token before each has gone
            ids, best, n = ids[keep], best[keep], n - 1
            first = np.cumsum(n) - n
            best[to] = far
            more = to[to < first + n - 1]
            best[more] = ranks(ids[more], ids[more + 1])
            less = to[to > first] - 1
            best[less] = ranks(ids[less], ids[less + 1])
        count = np.zeros(len(words), np.int64)
        for which, k, _ in done:
            count[which] = k
        for k, found in long.items():
            count[k] = len(found)
        offsets = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(int(offsets[-1]), np.int64)
        for which, k, tokens in done:
            out[np.repeat(offsets[which] - (np.cumsum(k) - k), k) + np.arange(len(tokens))] = tokens
        for k, found in long.items():
            out[offsets[k] : offsets[k + 1]] = found
        return out, offsets

    def merge_many(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word."""
        ids, offsets = self.merge_flat(words)
        flat = ids.tolist()
        return [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]

    def pieces(self, word: str) -> list[str]:
        """A word cut into runs of letters, single digits, runs of other signs and the usual contractions."""
        return [word] if word.isalpha() else self.split.findall(word)

    def by_library(self, words: list[str]) -> dict[str, list[int]]:
        """Token ids of the words with a code point that this Python's Unicode leaves unassigned: the tokenizer's own library may know its class, case or order."""
        newer = {c for c in set("".join(w for w in words if not w.isascii())) if unicodedata.category(c) == "Cn"}
        if not newer:
            return {}
        if not hasattr(self, "_library"):
            self._library = Tokenizer.from_file(self.path)
        odd = [w for w in words if not newer.isdisjoint(w)]
        return dict(zip(odd, (e.ids for e in self._library.encode_batch(odd, add_special_tokens=False)), strict=True))


def compile_lexicon(entries: dict[str, list[int]]) -> dict[str, np.ndarray]:
    """The minimal automaton of the words, as arrays.

    Words come sorted, so a state is finished, and merged with an equal one, once the next word leaves its
    path. ``arc``: state * 256 + byte, sorted; ``to``: state it leads to; ``add``: words that sort before
    those behind this arc, so sums along a path count; ``final``: states where words end; ``ids`` and
    ``start``: token ids of the words, in order.
    """
    words = sorted((w.encode("utf-8"), ids) for w, ids in entries.items())
    register: dict[bytes, int] = {}  # a state as bytes: whether words end there, then letter and target of each arc

    def finished(node: bytearray) -> bytes:
        return register.setdefault(bytes(node), len(register)).to_bytes(4, "big")

    path: list[bytearray] = [bytearray(1)]  # the states of the current word, whose last arcs are open
    last = b""
    for word, _ in words:
        same = len(os.path.commonprefix([word, last]))
        while len(path) > same + 1:
            done = finished(path.pop())
            path[-1] += last[len(path) - 1 : len(path)] + done
        path += [bytearray(1) for _ in word[same:]]
        path[-1][0] = 1
        last = word
    while len(path) > 1:
        done = finished(path.pop())
        path[-1] += last[len(path) - 1 : len(path)] + done
    root = int.from_bytes(finished(path[0]), "big")
    states = list(register)  # arcs lead to states finished before
    arcs = np.frombuffer(b"".join(x[1:] for x in states), np.uint8).reshape(-1, 5)
    to = np.ascontiguousarray(arcs[:, 1:]).view(">u4").ravel().astype(np.int32)
    ends, count = [x[0] for x in states], [(len(x) - 1) // 5 for x in states]
    size, add, at = array("q"), array("q"), 0  # words behind each state
    targets = to.tolist()
    for end, k in zip(ends, count, strict=True):
        n = end
        for target in targets[at : at + k]:
            add.append(n)
            n += size[target]
        at += k
        size.append(n)
    keys = np.repeat(np.arange(len(states), dtype=np.int64), count) * 256 + arcs[:, 0]
    start = np.zeros(len(words) + 1, np.int32)
    np.cumsum([len(x) for _, x in words], out=start[1:])
    ids = np.fromiter((i for _, x in words for i in x), np.int32, int(start[-1]))
    return {"arc": keys, "to": to, "add": np.array(add, np.int32), "final": np.array(ends, bool), "ids": ids.astype(np.uint16) if not len(ids) or ids.max() < 65_536 else ids, "start": start, "root": np.array([root], np.int64)}


def lexicon_file(parts: dict[str, np.ndarray]) -> bytes:
    """One file: a line of JSON that names the arrays and where they lie, then the arrays."""
    head, at = {}, 0
    for k, a in parts.items():
        head[k] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 8) * 8
    return b"".join([json.dumps(head).encode().ljust(1024), b"\n" * 8, *(a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0") for a in parts.values())])


class Lexicon:
    """The memory-mapped automaton."""

    def __init__(self, path: str):
        whole = np.asarray(np.memmap(path, np.uint8, "r"))
        head = json.loads(bytes(whole[:1024]))
        self.a = {k: whole[1032 + at : 1032 + at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, n, at) in head.items()}

    def find(self, words: list[str]) -> list[list[int] | None]:
        """Token ids of each word, None where the lexicon lacks it; all words advance together, byte by byte."""
        a, out = self.a, [None] * len(words)
        coded = [w.encode("utf-8", "replace") for w in words]
        size = np.array([len(w) for w in coded], np.int64)
        if not len(words) or not len(a["arc"]):
            return out
        data, first = np.frombuffer(b"".join(coded), np.uint8), np.cumsum(size) - size
        state, place, alive = np.full(len(words), a["root"][0]), np.zeros(len(words), np.int64), np.flatnonzero((size > 0) & (size <= MAX_LEXICON_CHARS * 4))
        ended: list[np.ndarray] = []
        step = 0
        while len(alive):
            key = state[alive] * 256 + data[first[alive] + step]
            at = np.minimum(np.searchsorted(a["arc"], key), len(a["arc"]) - 1)
            hit = a["arc"][at] == key
            alive, at = alive[hit], at[hit]
            state[alive] = a["to"][at]
            place[alive] += a["add"][at]
            step += 1
            over = size[alive] == step
            ended.append(alive[over])
            alive = alive[~over]
        done = np.concatenate(ended)
        done = done[a["final"][state[done]]]
        for k, i, j in zip(done.tolist(), a["start"][place[done]].tolist(), a["start"][place[done] + 1].tolist(), strict=True):
            out[k] = a["ids"][i:j].tolist()
        return out


def frequent_words(docs: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """(word): the most frequent words (runs of letters, signs or single digits) of all documents, ``most`` at most.

    Words of like counts go together. Each task counts before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = WordBpe(path), Counter()

        def flush() -> pa.RecordBatch:
            pieces: Counter = Counter()
            for word, n in seen.items():
                for x in bpe.pieces(word):
                    pieces[x] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.string()), pa.array(list(pieces.values()), pa.int64())], ["word", "n"])

        for part in slices(batches, text):
            texts = pa.array([bpe.normal(x) for x in part.column(0).to_pylist() if x], pa.large_string())
            found = pc.utf8_split_whitespace(texts).flatten().value_counts()
            seen.update(dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True)))
            if len(seen) > COUNT_WORDS:
                yield flush()
        yield flush()

    counts = docs.select(F.col(text).alias(text)).mapInArrow(count, "word string, n long").where(f"length(word) <= {MAX_LEXICON_CHARS}")
    totals = materialise(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    return most_frequent(totals, most).select("word")


def build_lexicon(docs: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> str:
    """Compile the lexicon of ``docs`` and hand its file to the executors; returns the file's name there."""

    def compiled(table: pa.Table) -> bytes:
        bpe, words = WordBpe(path), table.column("word").to_pylist()
        return lexicon_file(compile_lexicon(dict(zip(words, bpe.merge_many(words), strict=True))))

    spark = docs.sparkSession
    made = in_one_task(frequent_words(docs, path, text, most), compiled)  # LEXICON_WORDS short words at most
    where = put_file(spark, f"lexicon-{uuid.uuid4().hex}.bin", made)
    spark.sparkContext.addFile(where)
    return os.path.basename(where)


class Memo(dict):
    """A dict of two generations: what is not asked for while the younger one fills is forgotten."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that have to be worked out; those of the older generation move over."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        new = []
        for k in keys:
            if k not in self:
                if (v := self.old.get(k)) is None:
                    new.append(k)
                else:
                    self[k] = v
        return new


class Encoder:
    """Texts to token ids, by the lexicon and else by merging; remembers a bounded number of words."""

    def __init__(self, path: str, lexicon: str | None):
        self.bpe = WordBpe(path)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        self.memo = Memo(MEMO_WORDS)  # pieces between white space: (number of tokens, ids, tokens)

    def entry(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), " ".join([self.bpe.names[i] for i in ids])

    def learn(self, pieces: set[str]) -> None:
        """Make the memo hold all of the pieces."""
        memo = self.memo
        new = memo.missing(pieces)
        odd = self.bpe.by_library(new)
        memo.update((x, self.entry(ids)) for x, ids in odd.items())
        split = {x: self.bpe.pieces(x) for x in new if x not in odd}
        new = list({w for words in split.values() for w in words})
        found = dict(zip(new, self.lexicon.find(new) if self.lexicon else [None] * len(new), strict=True))
        rare = [w for w, ids in found.items() if ids is None]
        found.update(zip(rare, self.bpe.merge_many(rare), strict=True))
        for x, words in split.items():
            memo[x] = self.entry(found[words[0]] if len(words) == 1 else [i for w in words for i in found[w]])

    def entries(self, texts: list[str | None]) -> Iterator[list]:
        """The entries of each text's words and special tokens, in order."""
        cut = self.bpe.cut
        parts = [cut.split(x) if cut and x and "<|" in x else [x or ""] for x in texts]
        split = [[[p] if k % 2 else self.bpe.words(p) for k, p in enumerate(x)] for x in parts]
        self.learn({w for x in split for k, words in enumerate(x) if not k % 2 for w in words})
        of = self.memo.__getitem__
        for x in split:
            yield [e for k, words in enumerate(x) for e in ([self.entry([self.bpe.special[words[0]]])] if k % 2 else map(of, words))] if len(x) > 1 else list(map(of, x[0]))

    def numbered(self, texts: list[str | None]) -> tuple[dict[int, str], np.ndarray, np.ndarray, list]:
        """Texts that have to go word by word; where the words of each other one begin; the number of each word; and what each number stands for.

        Word by word go texts with the name of a special token, or with a separator that only Python takes for white
        space. '' is a word, too, at the ends of a text.
        """
        apart = {k: x for k, x in enumerate(texts) if x and ("<|" in x or PYTHON_ONLY.search(x))}
        plain = [self.bpe.spaced(x) if x and k not in apart else "" for k, x in enumerate(texts)]
        words = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn(distinct)
        return apart, words.offsets.to_numpy(), coded.indices.to_numpy(), [self.memo[w] for w in distinct]

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of tokens, ids in decimal, decoded text) of each text."""
        apart, offsets, which, entries = self.numbered(texts)
        n, ids, names = zip(*entries, strict=True) if entries else ((), (), ())
        total = np.concatenate([[0], np.cumsum(np.array(n, np.int64)[which])])[offsets] if len(which) else np.zeros(len(texts) + 1, np.int64)
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if k in apart:
                found = next(self.entries([apart[k]]))
                yield sum(x[0] for x in found), " ".join(x[1] for x in found), " ".join(x[2] for x in found)
            else:
                own = which[a:b].tolist()
                yield int(total[k + 1] - total[k]), " ".join([ids[i] for i in own]).strip(" "), " ".join([names[i] for i in own]).strip(" ")


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lexicon: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, one space between) and decoded text of every row."""
    lexicon = build_lexicon(docs, path, text) if lexicon is None else lexicon
    return _run(docs, path, doc_id, text, lexicon, digest=False)


def encode_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lexicon: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ids and text stay in the task."""
    lexicon = build_lexicon(docs, path, text) if lexicon is None else lexicon
    return _run(docs, path, doc_id, text, lexicon, digest=True)


def _run(docs: DataFrame, path: str, doc_id: str, text: str, lexicon: str, digest: bool) -> DataFrame:
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256") if digest else ("doc_id", "n_tokens", "ids", "decoded")

    def sha(x: str) -> str:
        return hashlib.sha256(x.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, SparkFiles.get(lexicon))
        for part in slices(batches, text):
            out = list(encoder.texts(part.column(1).to_pylist()))
            cols = [[sha(x) for _, x, _ in out], [sha(x) for _, _, x in out]] if digest else [[x for _, x, _ in out], [x for _, _, x in out]]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x[0] for x in out], pa.int64()), *(pa.array(c, pa.string()) for c in cols)], list(names))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias(text)).mapInArrow(run, f"doc_id long, n_tokens long, {names[2]} string, {names[3]} string")
