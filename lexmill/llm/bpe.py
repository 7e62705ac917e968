"""Byte-pair encoding by backtracking over longest token matches, and decoding by an offset table."""

from __future__ import annotations

import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmill.llm.common import map_rows, slices, worker_memory

REMEMBERED_BYTES = 48 << 20  # of words and their ids in a worker, counted roughly
# Scripts in which all Unicode versions agree on letters, digits, white space and lower case.
_OTHER = regex.compile("[^\x00-ɏḀ-ỿ‐-›€]")
_END = 0x1000  # a word's last symbol is its byte symbol moved up by this much


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte value."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class MergeTables:
    """What encoding and decoding need of a vocabulary: ranks, splits, prefixes, an automaton and the offset table.

    A token is a string of symbols, one for each byte; the last symbol of a token that
    ends a word is a symbol of its own, as the vocabulary has it. ``rank`` is the place of the
    merge that makes a token (-1: a single symbol), ``split`` its two parts. Tokens
    that merging never reaches are left out of the automaton.
    """

    def __init__(self, plan: dict):
        model = plan["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.suffix = suffix
        size = 1 + max([*vocab.values(), *(t["id"] for t in plan.get("added_tokens") or [])])
        names = [""] * size
        for name, k in vocab.items():
            names[k] = name
        for t in plan.get("added_tokens") or []:
            names[t["id"]] = t["content"]
        self.size, self.rank, self.split, self.pairs = size, [-1] * size, [(-1, -1)] * size, {}
        for place, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            made = vocab[left[:-len(suffix)] + right if suffix and left.endswith(suffix) else left + right]
            a, b = vocab[left], vocab[right]
            self.pairs.setdefault(a * size + b, place)
            if self.rank[made] < 0:
                self.rank[made], self.split[made] = place, (a, b)
        self.known_pairs: dict[int, bool] = {}
        symbols = {name: self._symbols(name) for name in vocab}
        self.length, token_of = [0] * size, {}
        reached = [False] * size
        for name, k in sorted(vocab.items(), key=lambda x: self.rank[x[1]]):
            s = symbols[name]
            a, b = self.split[k]
            reached[k] = len(s) == 1 if a < 0 else reached[a] and reached[b] and self._undo(a, b, self.rank[k])
            if reached[k]:
                token_of[s], self.length[k] = k, len(s)
        self.automaton = ahocorasick.Automaton()
        self.prefix = [-1] * size
        for s, k in token_of.items():
            self.automaton.add_word(s, k)
            for n in range(len(s) - 1, 0, -1):
                if s[:n] in token_of:
                    self.prefix[k] = token_of[s[:n]]
                    break
        self.automaton.make_automaton()
        spelled = [f"{name} ".encode("utf-8") for name in names]
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in spelled])])

    def _symbols(self, name: str) -> str:
        if self.suffix and name.endswith(self.suffix) and len(name) > len(self.suffix):
            body = name[:-len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + _END)
        return name

    def _undo(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge across the boundary of two neighbours comes before the merges that made them.

        Merges are undone from the latest; at each point the two symbols at the boundary
        must have no merge of their own that was due earlier. Of equal ones the left is first.
        """
        rank, split, pairs, size = self.rank, self.split, self.pairs, self.size
        while True:
            if pairs.get(a * size + b, limit) < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], split[a][1]
            elif rank[b] >= 0:
                limit, b = rank[b] + 1, split[b][0]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of two tokens gives just these two; remembered in a table."""
        key = a * self.size + b
        found = self.known_pairs.get(key)
        if found is None:
            if len(self.known_pairs) >= 500_000:
                self.known_pairs.clear()
            found = self.known_pairs[key] = self._undo(a, b, 1 << 60)
        return found

    def encode(self, symbols: str) -> list[int]:
        """Ids of one word. Each position is given up at most once, so the time is linear in the word."""
        n, length, prefix, compatible = len(symbols), self.length, self.prefix, self.compatible
        longest = [-1] * n
        for end, token in self.automaton.iter(symbols):
            longest[end + 1 - length[token]] = token  # later ends are longer matches
        alive, out, at = bytearray(b"\1") * (n + 1), [], 0
        token = longest[0] if n else -1
        while at < n:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + length[token]
                if alive[end] and (last < 0 or compatible(last, token)):
                    out.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    break
                token = prefix[token]
            else:
                if last < 0:
                    raise ValueError("the vocabulary lacks a symbol of the text")
                alive[at] = 0
                at -= length[out.pop()]
                token = last
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' spellings with a space between them, copied from one flat table by their offsets."""
        if not len(ids):
            return b""
        ids = ids.astype(np.int64)
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])][:-1].tobytes()


class WordEncoder:
    """Whole texts to ids: composed, lower-cased, split into words, each word merged on its own.

    Words are remembered within a bound of bytes. Strings of the special tokens are their
    ids, as the tokenizers library has it unless told otherwise.
    """

    def __init__(self, tokenizer_json: str):
        plan = json.loads(tokenizer_json)
        model = plan["model"]
        steps = [s.get("type") for s in (plan.get("normalizer") or {}).get("normalizers", [])]
        parts = (plan.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if (model.get("type") != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or plan.get("decoder")
                or [p["type"] for p in parts] != ["Split", "ByteLevel"] or parts[0].get("behavior") != "Removed"
                or not parts[0].get("invert") or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError("not a lower-casing byte-level vocabulary with word ends")
        self.tables = MergeTables(plan)
        self.words = regex.compile(parts[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall
        special = {t["content"]: t["id"] for t in plan.get("added_tokens") or []}
        self.special = {k: np.array([v], "<u4").tobytes() for k, v in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        plain = Tokenizer.from_str(tokenizer_json)
        self.normal, self.pre = plain.normalizer.normalize_str, plain.pre_tokenizer.pre_tokenize_str
        self.byte_of = byte_symbols()
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _merge(self, symbols: str) -> bytes:
        if self.tables.suffix:
            symbols = symbols[:-1] + chr(ord(symbols[-1]) + _END)
        return np.array(self.tables.encode(symbols), dtype="<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        if self.held > REMEMBERED_BYTES:
            self.known, self.held = {}, 0
        for w in words:
            ids = self.known[w] = self._merge("".join(map(self.byte_of.__getitem__, w.encode("utf-8", "replace"))))
            self.held += 160 + 2 * len(w) + len(ids)

    def _plain(self, text: str) -> bytes:
        if _OTHER.search(text):
            # Other scripts: letters and case as the tokenizer's own Unicode tables have them.
            return b"".join(self._merge(word) for word, _ in self.pre(self.normal(text)))
        words = self.words(unicodedata.normalize("NFC", text).lower())
        if fresh := {w for w in words if w not in self.known}:
            self._learn(fresh)
            fresh = {w for w in words if w not in self.known}  # forgotten meanwhile
            if fresh:
                self._learn(fresh)
        return b"".join(map(self.known.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers; none for null."""
        if not text:
            return b""
        if not self.special:
            return self._plain(text)
        return b"".join(self.special.get(part) or self._plain(part) for part in self.cut.split(text) if part)


_ENCODERS: dict[int, WordEncoder] = worker_memory({})


def word_encoder(tokenizer_json: str) -> WordEncoder:
    """One encoder in a worker, until it turns to another module's tasks."""
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(tokenizer_json)
    return _ENCODERS[key]


def _added(df: DataFrame, tokenizer_json: str, source: str, name: str, kind: str, arrow: pa.DataType, function
           ) -> DataFrame:
    df = df.drop(name) if name != source else df
    at = df.columns.index(source)
    shared = df.sparkSession.sparkContext.broadcast(tokenizer_json)

    def rows(batches):
        apply = function(word_encoder(shared.value))
        for batch in slices(batches, 256):
            made = pa.array([apply(x) for x in batch.column(at).to_pylist()], arrow)
            kept = [(c, f) for c, f in zip(batch.columns, batch.schema.names) if f != name]
            yield pa.RecordBatch.from_arrays([*[c for c, _ in kept], made], names=[*[f for _, f in kept], name])

    others = [c for c in df.columns if c != name]
    schema = df.select(*[F.col(f"`{c}`") for c in others]).limit(0).withColumn(name, F.lit(None).cast(kind)).schema
    return map_rows(df, rows, schema)


def encode_texts(docs: DataFrame, tokenizer_json: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` and ``ids`` of each whole text, packed as little-endian unsigned 32-bit numbers.

    The ids are those of exact pair merging, in the order of the merges. In place of merging, each
    word is covered by its longest tokens from the left (Aho-Corasick), a token is accepted
    if it is compatible with the one before, and otherwise shortened; positions from which no cover
    exists are given up once. Row by row and without a shuffle: a text must fit a
    task, a word takes time in proportion to its length. Null and empty texts have no ids; repeated rows get the
    same ids; an empty table stays empty; a column called ``name`` is replaced, others stay.
    """
    return _added(docs, tokenizer_json, text_col, name, "binary", pa.binary(), lambda e: e.encode)


def decode_ids(rows: DataFrame, tokenizer_json: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` and the text of the packed ids: the spellings of all tokens, special ones too, joined by spaces."""
    def text(e: WordEncoder):
        return lambda ids: e.tables.decode(np.frombuffer(ids or b"", "<u4")).decode("utf-8")

    return _added(rows, tokenizer_json, ids_col, name, "string", pa.string(), text)
