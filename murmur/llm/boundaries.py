"""Where pre-tokens begin, found for a whole batch at once by scans over codepoint classes."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np

LETTER, NUMBER, OTHER, JOINED, BLANK, SHORT, LONG = range(7)
FIRST = 7  # added to a class at the start of a text
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_JOINED, FREE, ONE_MORE, TWO_MORE = range(7)
STATES = 7
LANES = 256
# The contractions that are a pre-token of their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What each class does to each state, and whether a pre-token begins there; indexed class * STATES + state.

    FREE is the state in which any character begins a pre-token: at a text's start, after
    a blank that joins nothing, after a contraction. ONE_MORE and TWO_MORE are inside one.
    """
    then = np.zeros((2 * FIRST, STATES), np.uint8)
    begins = np.ones((2 * FIRST, STATES), bool)
    for kind, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        then[kind] = run
        begins[kind, [run, AFTER_JOINED]] = False
    then[LETTER, [ONE_MORE, TWO_MORE]] = FREE, ONE_MORE
    begins[LETTER, [ONE_MORE, TWO_MORE]] = False
    for kind, inside in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        then[kind] = inside
        then[kind, [IN_OTHERS, AFTER_JOINED]] = IN_OTHERS
        begins[kind, [IN_OTHERS, AFTER_JOINED]] = False
    then[JOINED], then[BLANK] = AFTER_JOINED, FREE
    for kind in range(FIRST):
        then[FIRST + kind] = then[kind, FREE]
    return then.ravel(), begins.ravel()


THEN, BEGINS = _tables()


def class_table(matches: Callable[[str], Callable[[str], str]]) -> np.ndarray:
    """LETTER, NUMBER, BLANK or OTHER of every code point; matches(pattern) gives a function of a text to its characters that match."""
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        find = matches(pattern)
        for at in [*range(0, 0xD800, 0x800), *range(0xE000, 0x110000, 0x800)]:
            found = find("".join(map(chr, range(at, at + 0x800))))
            table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return table


@cache
def rank_file_classes() -> np.ndarray:
    """Classes by the Unicode tables that tiktoken's patterns use."""
    import tiktoken

    def matches(pattern: str):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        return lambda text: bytes(probe.encode_ordinary(text)).decode()
    return class_table(matches)


@cache
def json_classes() -> np.ndarray:
    """Classes by the Unicode tables that the tokenizers library's patterns use."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    def matches(pattern: str):
        split = Split(Regex(pattern), "removed", invert=True)
        return lambda text: "".join(piece for piece, _ in split.pre_tokenize_str(text))
    return class_table(matches)


def _states_before(moves: np.ndarray) -> np.ndarray:
    """The state each lane starts in; moves[lane, state] is where a lane as a whole leads.

    Leading on is associative, so lanes compose in a doubling scan.
    """
    total = moves.copy()
    step = 1
    while step < len(total):
        total[step:] = np.take_along_axis(total[step:], total[:-step].copy(), 1)
        step *= 2
    return np.r_[np.uint8(FREE), total[:-1, FREE]]


def begin_flags(kinds: np.ndarray) -> np.ndarray:
    """True where a pre-token begins, blanks aside."""
    n = len(kinds)
    depth = max(1, min(LANES, n))
    lanes = -(-n // depth)
    padded = np.full(lanes * depth, BLANK, np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(lanes, depth).T) * np.uint8(STATES)
    moves = np.tile(np.arange(STATES, dtype=np.uint8), (lanes, 1))
    for column in columns:
        moves = THEN.take(moves + column[:, None])
    state = _states_before(moves)
    flags = np.empty((depth, lanes), bool)
    for j, column in enumerate(columns):
        at = state + column
        BEGINS.take(at, out=flags[j], mode="clip")
        state = THEN.take(at)
    return flags.T.ravel()[:n]


def pre_tokens(texts: list[str], table: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts' bytes in a row, the byte where each pre-token begins (and the end), and each text's first pre-token (and the end)."""
    whole = "".join(texts)
    n = len(whole)
    ends = np.cumsum([len(t) for t in texts])
    code = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    data = whole.encode()
    if not n:
        return data, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    first = np.zeros(n + 1, bool)
    first[np.r_[0, ends]] = True
    kinds = table[code]
    blank = kinds == BLANK
    # The last blank of a run joins what follows if it is a space; else it stands alone.
    ends_run = np.zeros(n, bool)
    ends_run[:-1] = blank[:-1] & ~blank[1:] & ~first[1:n]
    kinds[ends_run & (code == 32)] = JOINED
    marks = np.flatnonzero(code == 39)
    if len(marks):
        for word in CONTRACTIONS:
            at = marks[marks + len(word) <= n]
            for k, letter in enumerate(word[1:], 1):
                at = at[(code[at + k] == ord(letter)) & ~first[at + k]]
            kinds[at] = SHORT if len(word) == 2 else LONG
    begins = np.zeros(n, bool)
    begins[1:] = blank[1:] & ~blank[:-1]
    begins |= ends_run | first[:n]
    kinds[first[:n]] += FIRST
    flags = begin_flags(kinds)
    begins |= flags & ~blank
    starts = np.flatnonzero(begins)
    pieces = np.searchsorted(starts, np.r_[0, ends])
    starts = np.r_[starts, n]
    if len(data) != n:
        width = np.ones(n, np.int64)
        for limit in (0x80, 0x800, 0x10000):
            width += code >= limit
        starts = np.r_[0, np.cumsum(width)][starts]
    return data, starts, pieces
