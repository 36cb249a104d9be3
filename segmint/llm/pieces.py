"""SentencePiece BPE encoding and decoding by a merge-type prefix table.

For every prefix of a word exactly one token can be the last of its encoding. The
table stores that token: of the vocabulary pieces that end at the position (all
matches of an Aho-Corasick automaton) it is the one that is compatible with the
last token of the prefix in front of it, i.e. the two stay apart when their
joined text is merged. The ids are read off backwards from the last entry. A valid
chain of pairs is the encoding: as long as no merge has crossed a border between two
tokens, each side is merged as if alone, so the first merge to cross one would also
cross it in the pair's own text.

No vocabulary piece has the space mark after another character, and none has certain
signs after a letter, so a text is cut there and distinct words are encoded once while
they stay in a bounded cache. (A model with such a piece has whole texts as words.)
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import Cache, per_worker, prepare

MARK = "▁"  # the space mark of sentencepiece models (fixed value)
CACHE_WORDS = 400_000
CACHE_PAIRS = 400_000
CUT = "\x1f"  # marks cuts; texts that hold it are coded one by one
#: texts coded at a time: bounds the task's memory
CHUNK_ROWS = 2000


class PieceCoder:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: list[int] = [0] * 256
        self.text: dict[int, str] = {}
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                p = sp.id_to_piece(i)
                self.pieces[p], self.score[p], self.text[i] = i, sp.get_score(i), p
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.cut = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        self.auto = ahocorasick.Automaton()
        for p in self.pieces:
            self.auto.add_word(p, p)
        self.auto.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.histories: dict[str, tuple | None] = {}
        self.words = Cache(CACHE_WORDS)
        after_letter = {p[k] for p in self.pieces for k in range(1, len(p)) if p[k - 1].isalpha()}
        self.signs = "".join(re.escape(c) for c in '.,;:!?"\n|#%&*$' if c not in after_letter)
        border = f"(?<=[^{MARK}])(?={MARK})" + (f"|(?<=[^\\W\\d_])(?=[{self.signs}])" if self.signs else "")
        self.cut_words = re.compile(border).split if self.cut else lambda text: [text]

    def history(self, token: str):
        """How a token is merged on its own: two lists of (score, end symbol after the merge),
        for its right and its left end; None if merging its text doesn't give the token."""
        if token in self.histories:
            return self.histories[token]
        parts, right, left = list(token), [], []
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            right.append((best, parts[-1]))
            left.append((best, parts[0]))
        got = self.histories[token] = (right, left) if len(parts) == 1 else None
        return got

    def _apart(self, a: str, b: str) -> bool:
        hb = self.history(b)
        if hb is None or not a:
            return hb is not None
        ha = self.history(a)
        if ha is None:
            return False
        right, left, i, j, x, y = ha[0], hb[1], 0, 0, a[-1], b[0]
        none = float("-inf")
        while True:
            across = self.score.get(x + y, none)
            in_a = right[i][0] if i < len(right) else none
            in_b = left[j][0] if j < len(left) else none
            if across > none and across > in_a and across >= in_b:  # of equal scores the leftmost goes first
                return False
            if in_a == in_b == none:
                return True
            if in_a >= in_b:
                x = right[i][1]
                i += 1
            else:
                y = left[j][1]
                j += 1

    def apart(self, a: str, b: str) -> bool:
        """Whether tokens a and b stay side by side when their joined text is merged ('' in front: b alone).

        The merges inside a and inside b are replayed in the order of their scores; the
        two fail the test when a merge across their border comes first."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            got = self.pairs[a, b] = self._apart(a, b)
        return got

    def tokens(self, word: str) -> list[str]:
        """Prefix table over the word, then backwards."""
        n, pairs = len(word), self.pairs
        ends: list[list[str]] = [[] for _ in range(n)]
        for at, p in self.auto.iter(word):
            ends[at].append(p)
        last: list[str | None] = ["", *[None] * n]
        for i, found in enumerate(ends, 1):
            for p in found:
                before = last[i - len(p)]
                if before is not None:
                    ok = pairs.get((before, p))
                    if ok or ok is None and self.apart(before, p):
                        last[i] = p
                        break
            else:
                c = word[i - 1]
                if c not in self.pieces and last[i - 1] is not None:  # no piece: its own token, coded as bytes
                    last[i] = c
        out, i = [], n
        while i:
            out.append(last[i])
            i -= len(last[i])
        return out[::-1]

    def ids(self, word: str) -> list[int]:
        out: list[int] = []
        for t in self.tokens(word):
            i = self.pieces.get(t)
            out.extend([i] if i is not None else [self.bytes[b] for b in t.encode("utf-8", "surrogatepass")])
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte runs as UTF-8, space marks as spaces, the one added in front dropped."""
        out, run = [], bytearray()
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join([self.text.get(i, "") for i in ids]).replace(MARK, " ")
            return text[1:] if text.startswith(" ") else text
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.text.get(i, ""))
        out.append(run.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text

    def _word(self, word: str):
        """Comma-joined ids; with the decoded text where that isn't the word itself with spaces for marks."""
        got = self.words.find(word)
        if got is None:
            ids = self.ids(word)
            got = ",".join(map(str, ids))
            # the extra space mark in front is what decode() drops
            plain = self.decode([self.pieces[MARK], *ids])
            if plain != word.replace(MARK, " "):
                got = (got, plain)
            self.words.put(word, got)
        return got

    def code(self, text: str | None) -> tuple[str, str]:
        """Comma-joined ids of a whole text and the text they decode to; null and empty: both empty."""
        if not text:
            return "", ""
        words = self.cut_words(MARK + text.replace(" ", MARK))
        got = [self._word(w) for w in words]
        ids = ",".join([g if isinstance(g, str) else g[0] for g in got])
        plain = "".join([w.replace(MARK, " ") if isinstance(g, str) else g[1] for g, w in zip(got, words, strict=True)])
        return ids, plain[1:] if plain.startswith(" ") else plain

    def code_all(self, texts: pa.Array) -> tuple[list[str], list[str]]:
        """``code`` of many texts: Arrow cuts them and numbers their words, each distinct word is looked up once."""
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, f"^ | $|  |[{MARK}{CUT}]")  # runs of marks, and marks in the text
        odd = pc.or_(odd, pc.equal(texts, "")).to_numpy(zero_copy_only=False) | (not self.cut)
        some = texts.filter(pa.array(~odd))
        cut = pc.replace_substring(some, " ", CUT + MARK)
        if self.signs:
            cut = pc.replace_substring_regex(cut, f"(\\pL)([{self.signs}])", f"\\1{CUT}\\2")
        words = pc.split_pattern(pc.binary_join_element_wise(MARK, cut, ""), CUT)
        numbered = words.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        got = [self._word(w) for w in distinct]
        lists = lambda values: pa.ListArray.from_arrays(words.offsets, pa.array(values, pa.string()).take(numbered.indices))
        ids = pc.binary_join(lists([g if isinstance(g, str) else g[0] for g in got]), ",").to_pylist()
        if all(isinstance(g, str) for g in got):
            plain = some.to_pylist()
        else:
            plain = [t[1:] for t in pc.binary_join(lists([w.replace(MARK, " ") if isinstance(g, str) else g[1] for g, w in zip(got, distinct, strict=True)]), "").to_pylist()]
        each = iter(zip(ids, plain, strict=True))
        both = [self.code(texts[k].as_py()) if x else next(each) for k, x in enumerate(odd)]
        return [b[0] for b in both], [b[1] for b in both]


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Ids and decoded text of every whole text: doc_id, ids (array<int>), decoded.

    ``digest`` gives doc_id, n_tokens, ids_sha256, decoded_sha256 instead, made in the
    same task so that no id crosses to the JVM. Row by row: null and empty texts have
    no ids, repeated rows and null doc_ids are coded like any other, other columns are
    not read.
    """
    prepare(docs.sparkSession)

    def run(batches):
        coder = per_worker(PieceCoder, model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(lo, CHUNK_ROWS)
                ids, plain = coder.code_all(part.column(1))
                if digest:
                    out = [pa.array([i.count(",") + 1 if i else 0 for i in ids], pa.int64()),
                           pa.array([hashlib.sha256(i.encode()).hexdigest() for i in ids]),
                           pa.array([hashlib.sha256(t.encode()).hexdigest() for t in plain])]
                else:
                    out = [pa.array([[int(x) for x in i.split(",")] if i else [] for i in ids], pa.list_(pa.int32())), pa.array(plain, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), *out], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "ids", "decoded"]
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<int>, decoded string"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, kinds)
