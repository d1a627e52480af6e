"""Reading of notice titles and links: what a title names, and whether two titles name the same call."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from urllib.parse import unquote

# --- fixed values -------------------------------------------------------------------
#: Words that say what kind of text it is, not which call.
KIND_WORDS = "edital chamada publica publico selecao convocatoria cp chamamento numero num nro".split()
#: Words that decorate a title.
DECORATION_WORDS = "novo reaberto reaberta prorrogado prorrogada prorrogacao retificado retificada retificacao alteracao alterado errata republicado atualizado saiba mais integra pdf mb kb docx download baixar aberto aberta encerrado resultado anexos inscricoes abertas clique aqui".split()
STOP_WORDS = "de do da dos das e em com para por a o as os ao aos no na nos nas n um uma no".split()
#: Query parameters that only say where a visitor came from.
TRACKING = ("utm_", "gclid", "fbclid", "mc_cid", "mc_eid", "msclkid", "origem", "ref_src")
# ------------------------------------------------------------------------------------

_MARKS = re.compile("[\u0300-\u036f]+")
_STOP = frozenset(STOP_WORDS)
_EMPTY = frozenset(KIND_WORDS) | frozenset(DECORATION_WORDS)
_NUMBER_YEAR = re.compile(r"(?<!\d)(\d{1,4})\s*(?:/|-|\.|,|\bde\b|\s)\s*((?:19|20)\d\d)(?!\d)")
_YEAR = re.compile(r"(?<!\d)((?:19|20)\d\d)(?!\d)")
_TOKEN = re.compile(r"[a-z0-9]+")
_SPOILT = re.compile("[ÃÂâ][\u0080-ÿŒœŠšŽžŸƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]")
#: The same after the text was put in lower case.
_LOWERED = re.compile("[ãâ](?=[\u0080-\u009f\u00a1-\u00bfŒœŠšŽžŸƒˆ˜–—‘’‚“”„†‡•…‰‹›€™])")


def repaired(text: str) -> str:
    """Text whose UTF-8 bytes were read as a one-byte code page, read properly (up to twice)."""
    text = _LOWERED.sub(lambda m: m[0].upper(), text)
    for _ in range(2):
        if not _SPOILT.search(text):
            break
        raw = bytearray()
        for ch in text:
            try:
                raw += ch.encode("cp1252")
            except UnicodeEncodeError:
                raw += ch.encode("latin-1") if ord(ch) < 256 else ch.encode("utf-8")
        new = raw.decode("utf-8", "ignore")
        if new == text or not new:
            break
        text = new
    return text


def unmarked(text: str) -> str:
    """Without combining characters."""
    text = _MARKS.sub("", text)
    if not text.isascii():  # the rare ones outside the usual block
        for ch in {c for c in set(text) if unicodedata.combining(c)}:
            text = text.replace(ch, "")
    return text


def plain(text: str | None) -> str:
    """Lower case without diacritics, broken encodings repaired."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    return unmarked(unicodedata.normalize("NFKD", repaired(text)).lower())


@lru_cache(maxsize=200_000)
def _shortened(word: str) -> frozenset[str]:
    return frozenset([word, *(word[:i] + word[i + 1 :] for i in range(len(word)))])


@lru_cache(maxsize=64)
def _empty_index(issuers: tuple[str, ...]) -> tuple[frozenset[str], frozenset[str]]:
    words = _EMPTY | frozenset(issuers)
    return words, frozenset(x for w in words if len(w) >= 5 for x in _shortened(w))


@lru_cache(maxsize=200_000)
def _is_empty(token: str, issuers: tuple[str, ...]) -> bool:
    words, near = _empty_index(issuers)
    return token in words or len(token) >= 5 and not near.isdisjoint(_shortened(token))


def read_title(title: str | None, issuers: tuple[str, ...] = ()) -> tuple[int, int, list[str]]:
    """``(number, year, content words)`` of a title; 0 where it names none.

    Content words are what remains of the words without stop words, kinds of notice,
    decorations and issuers (each also with one letter off).
    """
    text = plain(title)
    found = _NUMBER_YEAR.search(text)
    if found:
        number, year = int(found[1]), int(found[2])
        text = text[: found.start()] + " " + text[found.end() :]
    else:
        number, year = 0, int(m[1]) if (m := _YEAR.search(text)) else 0
    words = [w for w in _TOKEN.findall(text) if w not in _STOP and not w.isdigit() and not _is_empty(w, issuers) and len(w) > 1]
    return number, year, words


def off_by(a: str, b: str, most: int) -> int:
    """Edit distance with adjacent swaps (restricted), or ``most + 1`` if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [0] * (len(b) + 1), list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            c = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                c = min(c, before[j - 2] + 1)
            now[j] = c
        if min(now) > most:
            return most + 1
        before, last = last, now
    return last[-1]


@lru_cache(maxsize=400_000)
def alike(a: str, b: str) -> bool:
    """Two words are the same but for slips: one or two letters off, or one a cut-off form of the other."""
    if a == b:
        return True
    short, long = sorted((a, b), key=len)
    if len(short) < 3:
        return False
    if long.startswith(short) or len(short) >= 4 and short[-1] == "s" and long.startswith(short[:-1]):
        return True
    most = 1 if len(short) < 6 else 2
    return off_by(a, b, most) <= most


def agreement(a: list[str], b: list[str]) -> tuple[float, list[str], list[str]]:
    """``(share of letters in matched words, unmatched words of a, of b)``."""
    rest_b = list(b)
    rest_a = []
    hit = 0
    for w in a:
        if w in rest_b:
            rest_b.remove(w)
            hit += 2 * len(w)
        else:
            rest_a.append(w)
    left = []
    for w in rest_a:
        other = next((x for x in rest_b if alike(w, x)), None)
        if other is None:
            left.append(w)
        else:
            rest_b.remove(other)
            hit += len(w) + len(other)
    total = sum(map(len, a)) + sum(map(len, b))
    return (hit / total if total else 0.0), left, rest_b


def same_subject(a: str, b: str, least: float = 0.8) -> bool:
    """Whether two content word lists (joined by spaces) name the same subject and place.

    Words may be missing on one side; a word that stands against quite another word (a
    different place, say) makes it another call.
    """
    if a == b:
        return True
    wa, wb = a.split(), b.split()
    share, only_a, only_b = agreement(wa, wb)
    only_a, only_b = [w for w in only_a if len(w) >= 4], [w for w in only_b if len(w) >= 4]
    if share >= least and not (only_a and only_b):
        return True
    if share >= least and len(only_a) == len(only_b) and all(min(off_by(x, y, 4) / max(len(x), len(y)) for y in only_b) <= 0.4 for x in only_a):
        return True
    joined_a, joined_b = "".join(wa), "".join(wb)  # lost blanks
    return len(wa) != len(wb) and off_by(joined_a, joined_b, 3) <= 3


def read_link(link: str | None, listings: frozenset[str] = frozenset()) -> str | None:
    """One spelling for all addresses of a page or file; null for none, home pages and ``listings``.

    Scheme, ``www.``, default ports, case of the host, fragment, tracking parameters,
    needless percent-encoding, order of parameters and a final slash don't matter.
    """
    if link is None or not link.strip():
        return None
    text = re.sub(r"^\s*[A-Za-z][A-Za-z0-9+.-]*://", "", link.strip()).split("#", 1)[0]
    head, _, query = text.partition("?")
    host, slash, path = head.partition("/")
    host = re.sub(r":(?:80|443)$", "", host.lower())
    host = re.sub(r"^(?:www\.)+", "", host)
    path = re.sub("/+", "/", unquote(path)).rstrip("/")
    pairs = sorted(unquote(x) for x in query.split("&") if x and not x.lower().startswith(TRACKING))
    if not path and not pairs:
        return None
    out = f"{host}/{path}" + ("?" + "&".join(pairs) if pairs else "")
    return None if out in listings else out
