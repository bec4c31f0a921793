"""Quality by counts and by tokeniser fertility: how well two public vocabularies fit a text, against its language."""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm.bpe import strips
from murmur.llm.common import held, prepare, settled
from murmur.llm.merging import merged_slices

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SECOND = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MIN_WORDS, MAX_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_tokens long, n_bytes_spelt long, token_entropy double, script string, n_tokens_second long, vote long")

#: Characters per token lie, for either vocabulary, within the fences of the text's language, script and length: FENCE times
#: the distance of the quartiles beyond them (Tukey's rule) over the texts of the table that pass the base rule. Lengths
#: are classed by powers of two, as a ratio over 80 words varies more than one over 800. A fence is drawn towards that of
#: all languages of its script and length, and that towards the script's fixed band, as if PRIOR texts had told so:
#: with few texts the band decides, with many the texts, and no number of them makes another rule.
FENCE, PRIOR, ACCURACY = 1.5, 20, 100_000
#: Words whose pieces a Python worker remembers; beyond it forgets all of them, between two strips of texts. Bytes of a long word.
REMEMBERED, LONG = 200_000, 1000

#: Fixed bands by script of a text's letters: characters per token (least, most) and the largest share of tokens that
#: spell out single bytes. Alphabets the vocabulary knows give 2 to 5 characters a token; noise under 1.5 and long
#: runs over 8. Scripts it knows little are spelt in bytes by nature, so their bands are wide. Token entropy is
#: measured against the most that so many tokens can have: prose of any length is over a third of it.
BANDS = {
    "LATIN": (1.5, 8.0, 0.05),
    "CYRILLIC": (1.2, 8.0, 0.10),
    "GREEK": (0.7, 4.0, 0.30),
    "CJK": (0.3, 2.0, 0.90),
    "HIRAGANA": (0.4, 2.0, 0.60),
    "KATAKANA": (0.4, 2.0, 0.60),
    "HANGUL": (0.3, 2.0, 0.95),
    "ARABIC": (0.5, 3.0, 0.50),
    "HEBREW": (0.5, 3.0, 0.50),
    "DEVANAGARI": (0.4, 3.0, 0.60),
    "THAI": (0.3, 2.0, 0.80),
}
#: Unknown scripts are spelt in bytes, up to four a character and a token for the blank; known pieces are 1 or 2 long.
OTHER_BAND = (0.25, 2.0, 1.0)
MIN_ENTROPY_SHARE = 0.3


@cache
def _scripts() -> tuple[np.ndarray, list[str]]:
    """For each code point up to U+FFFF the number of its letters' script, by the first word of its name; 0 for no letter."""
    names = ["", "OTHER"]
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        if code == 0x10000:
            table[code:] = 1
            break
        if unicodedata.category(chr(code))[0] == "L":
            name = unicodedata.name(chr(code), "OTHER").split()[0].split("-")[0]
            name = name if name in BANDS else "OTHER"
            if name not in names:
                names.append(name)
            table[code] = names.index(name)
    return table, names


def script_of(text: str) -> str | None:
    """The script of most letters; None without letters."""
    if text.isascii():
        return "LATIN" if any(map(str.isalpha, text)) else None
    table, names = _scripts()
    counts = np.bincount(table[np.frombuffer(text.encode("utf-32-le"), "<u4")], minlength=2)
    counts[0] = 0
    return names[int(counts.argmax())] if counts.any() else None


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Words(dict):
    """Numbers of words, and by number what the vocabularies make of each: looked up once, summed in arrays."""

    def __init__(self, path: str, second: str):
        import sentencepiece
        import tiktoken
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelt = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.ranks = rank_file(second)
        self.second = tiktoken.Encoding("second", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.clear()
        #: By number: pieces, pieces by the second vocabulary, bytes spelt and hash; and the pieces of all words in a row.
        self.table, self.flat = np.zeros((0, 4), np.int64), np.zeros(0, np.uint16)

    def _second(self, word: bytes) -> int:
        # The library takes a word's square in time, the heap does not.
        return len(self.second._encode_single_piece(b" " + word) if len(word) < LONG else merged_slices(b" " + word, self.ranks))

    def _learn(self, words: list[bytes]) -> None:
        self.update(zip(words, range(len(self), len(self) + len(words))))
        pieces = self.model.encode([w.decode() for w in words], num_threads=1)
        flat = np.fromiter(chain.from_iterable(pieces), np.uint16)
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        spelt = np.diff(np.r_[0, np.cumsum(self.spelt[flat])][np.r_[0, np.cumsum(n)]])
        hashed = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64) >> np.uint64(1)
        self.table = np.concatenate([self.table, np.stack([n, [self._second(w) for w in words], spelt, hashed.astype(np.int64)], 1)])
        self.flat = np.concatenate([self.flat, flat])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.get, words))
        if new := list(dict.fromkeys(w for w, n in zip(words, found) if n is None)):
            self._learn(new)
            found = list(map(self.__getitem__, words))
        return np.array(found, np.int64)


class Fertility:
    """Measures of texts, a strip of them at a time."""

    def __init__(self, path: str, second: str = SECOND):
        self.words = Words(path, second)

    def measure(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        if len(self.words) > REMEMBERED:
            self.words.forget()
        every, ends, counts = [], [0], []
        for text in texts:
            data = text.encode()
            every += data.split()  # bytes split at space and \x09-\x0D
            ends.append(len(every))
            lines = [line for line in data.split(b"\n") if line.strip()] if b"\n" in data else []
            chars = len(text) if len(data) == len(text) else len(data.translate(None, _CONTINUED))
            blanks = len(data) - len(data.translate(None, b" \t\n\x0b\x0c\r"))
            counts.append((chars - blanks, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines))))
        ends = np.array(ends)
        number = self.words.numbers(every)
        begin = np.r_[0, np.cumsum(self.words.table[:, 0])]
        own = self.words.table[number]

        def by_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.r_[0, np.cumsum(values)][ends])
        tokens = by_text(own[:, 0])
        at = np.repeat(begin[number] - np.r_[0, np.cumsum(own[:, 0])][:-1], own[:, 0]) + np.arange(tokens.sum())
        word_chars, n_symbols, n_dup_lines = np.array(counts, np.int64).reshape(-1, 3).T
        return {"n_words": np.diff(ends), "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
                "n_repeat_words": by_text(in_repeats(number, ends)), "n_tokens": tokens, "n_bytes_spelt": by_text(own[:, 2]),
                "token_entropy": entropies(self.words.flat[at], tokens), "script": [script_of(t) for t in texts],
                "n_tokens_second": by_text(own[:, 1]), "vote": least_windows(own[:, 3], ends)}


_CONTINUED = bytes(range(0x80, 0xC0))
#: Words of a window.
WINDOW = 3


def in_repeats(number: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each word whether it is in a window that its text holds twice or more; texts end at `ends`."""
    inside = np.zeros(len(number), bool)
    if len(number) < window:
        return inside
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    code, size = text, len(ends)
    used, number = np.unique(number, return_inverse=True)
    for k in range(window):
        if size * len(used) >= 1 << 62:  # number the windows so far, so that the product has room
            code = np.unique(code, return_inverse=True)[1]
            size = len(code) + 1
        code, size = code[:len(number) - k] * len(used) + number[k:], size * len(used)
    whole = np.flatnonzero(text[:len(code)] == text[window - 1:])  # of windows within one text
    order = whole[np.argsort(code[whole], kind="stable")]
    same = np.r_[False, code[order][1:] == code[order][:-1]]
    again = order[same | np.r_[same[1:], False]] if len(order) else order
    for k in range(window):
        inside[again + k] = True
    return inside


def entropies(ids: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Entropy in bits of each text's token ids; texts stand one after the other, `tokens` long."""
    text = np.repeat(np.arange(len(tokens)), tokens)
    key = np.sort(text << 16 | ids)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    owner = key[first] >> 16
    share = np.diff(np.r_[first, len(key)]) / tokens[owner]
    return np.maximum(0.0, np.bincount(owner, -share * np.log2(share), len(tokens)))


def least_windows(hashed: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The least hash of each text's windows, 0 without one: near copies mostly share it, and have one vote."""
    out = np.zeros(len(ends) - 1, np.int64)
    whole = np.flatnonzero(np.diff(ends) >= window)
    if len(whole):
        h = hashed.astype(np.uint64)
        mixed = np.zeros(len(h) - window + 1, np.uint64)
        for k in range(window):
            mixed = (mixed ^ h[k:len(mixed) + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        bounds = np.ravel(np.stack([ends[whole], ends[whole + 1] - window + 1], 1))
        out[whole] = (np.minimum.reduceat(np.r_[mixed, mixed[-1:]], bounds)[::2] >> np.uint64(1)).astype(np.int64)
    return out


def measure(spark: SparkSession, text: Column, path: str = VOCABULARY) -> Column:
    """Counts and fertility measures of a whole text as one struct; null and empty texts measure zero, without script."""
    prepare(spark)
    kinds = {"double": pa.float64(), "string": pa.string(), "long": pa.int64()}
    fields = [(n, kinds[k]) for n, k in map(str.split, MEASURES.split(", "))]

    @F.arrow_udf(f"struct<{MEASURES.replace(' ', ':').replace(',:', ',').replace('long', 'bigint')}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held(Fertility, path)
        for batch in batches:
            found = [own.measure(part) for part in strips([t or "" for t in batch.to_pylist()], len)]
            yield pa.StructArray.from_arrays([pa.concat_arrays([pa.array(f[n], k) for f in found]) if found else pa.array([], k)
                                              for n, k in fields], [n for n, _ in fields])
    return run(text)


def _class(n_words: Column) -> Column:
    """The length class: how many binary digits the number of words has."""
    return F.length(F.bin(n_words))


def _quartiles() -> list[Column]:
    """Aggregates n, q and q2: votes and quartiles of characters per token by either vocabulary."""
    return [F.count("*").alias("n"), *[F.percentile_approx(F.col("word_chars") / F.col(t), [0.25, 0.75], ACCURACY).alias(q)
                                       for t, q in (("n_tokens", "q"), ("n_tokens_second", "q2"))]]


def _drawn(prior: dict[str, Column]) -> list[Column]:
    """FENCES from n, q and q2, drawn towards `prior`."""
    out = []
    for name in FENCES:
        q = F.col("q2" if name.endswith("second") else "q")
        reach = FENCE * (q[1] - q[0])
        own = q[0] - reach if name.startswith("low") else q[1] + reach
        out.append(((F.col("n") * own + PRIOR * prior[name]) / (F.col("n") + PRIOR)).alias(name))
    return out


FENCES = ("low", "high", "low_second", "high_second")


def fences(measured: DataFrame, m: str, by: str = "lang") -> DataFrame:
    """by, script, class (of length) and FENCES: characters per token by either vocabulary; see FENCE.

    From measures in column `m`. Texts of one language, script and length that share their
    least window have one vote, that of the least measures: so a text copied a thousand
    times, with or without changes, doesn't narrow the fences.
    """
    v = F.col(m)
    texts = measured.where(~judge(v)["base_failed"] & (v["n_tokens"] > 0) & v["script"].isNotNull()).select(
        F.col(by).alias("by"), v["script"].alias("script"), _class(v["n_words"]).alias("class"), v["vote"].alias("vote"),
        F.struct(*[v[n].alias(n) for n in ("word_chars", "n_tokens", "n_tokens_second")]).alias("s"))
    votes = settled(texts.groupBy("by", "script", "class", "vote").agg(F.min("s").alias("s")).select("by", "script", "class", "s.*"), "votes")
    band = {"low": _band("script", 0), "high": _band("script", 1)}
    band |= {"low_second": band["low"], "high_second": band["high"]}
    scripts = votes.groupBy("script", "class").agg(*_quartiles()).select("script", "class", *_drawn(band))
    groups = votes.groupBy("by", "script", "class").agg(*_quartiles())
    prior = {n: F.col(f"prior.{n}") for n in FENCES}
    told = groups.join(scripts.select("script", "class", F.struct(*FENCES).alias("prior")), ["script", "class"])
    return told.select("by", "script", "class", *_drawn(prior))


def fenced(measured: DataFrame, m: str, name: str, by: str = "lang") -> DataFrame:
    """`measured`, read twice, with the fences of each row's language, script and length as a struct.

    The fences are a table of their own, so that all rows meet the same ones; null for rows
    that fail the base rule and have no fellows that pass it. A plain join: Spark broadcasts
    the fences if they are small and splits a hot group otherwise.
    """
    own = settled(fences(measured, m, by), "fences")
    own = own.select(F.col("by").alias(f"{name}_by"), F.col("script").alias(f"{name}_script"), F.col("class").alias(f"{name}_class"),
                     F.struct(*FENCES).alias(name))
    same = (F.col(by).eqNullSafe(F.col(f"{name}_by")) & (F.col(m)["script"] == F.col(f"{name}_script"))
            & (_class(F.col(m)["n_words"]) == F.col(f"{name}_class")))
    return measured.join(own, same, "left").drop(f"{name}_by", f"{name}_script", f"{name}_class")


def _band(script: str | Column, i: int) -> Column:
    script = F.col(script) if isinstance(script, str) else script
    return F.coalesce(*[F.when(script == s, F.lit(b[i])) for s, b in BANDS.items()], F.lit(OTHER_BAND[i]))


def judge(m: Column, fence: Column | None = None) -> dict[str, Column]:
    """base_failed, kept and the reasons, from measures and the fences of their group.

    A text without words fails the base rule; one without letters is not kept, as no script tells what would fit it.
    """
    base_failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"])
    per_token, per_second = m["word_chars"] / m["n_tokens"], m["word_chars"] / m["n_tokens_second"]
    spelt = m["n_bytes_spelt"] / m["n_tokens"]
    most = F.log2(F.least(m["n_tokens"], F.lit(32_000)))
    if fence is None:  # the band that every fence begins with
        outside = ~per_token.between(_band(m["script"], 0), _band(m["script"], 1))
    else:
        outside = ~(per_token.between(fence["low"], fence["high"]) & per_second.between(fence["low_second"], fence["high_second"]))
    misfit = F.when((m["n_tokens"] > 0) & m["script"].isNotNull(), outside | (spelt > _band(m["script"], 2))
                    | (m["token_entropy"] < MIN_ENTROPY_SHARE * most)).otherwise(True)
    return {"base_failed": base_failed, "kept": ~base_failed & ~F.coalesce(misfit, F.lit(True)),
            "chars_per_token": F.when(m["n_tokens"] > 0, per_token), "byte_share": F.when(m["n_tokens"] > 0, spelt)}
