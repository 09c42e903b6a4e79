"""URL filter: a bit-parallel wildcard automaton (extended Shift-And in several words).

All rules are globs over the canonical URL, packed one after another into one
bit vector: a bit per symbol of a pattern, 64 to a word.  A step reads one byte
of every URL of a batch and moves all patterns of all URLs at once,

    state = ((state << 1, with carries, without patterns' first bits) | starts) & reads[byte]
            | state & stays[byte]

where ``reads`` has the bits whose symbol reads the byte and ``stays`` those that may
repeat on it (a star after the symbol, the later bytes of one character).  URLs are stepped in the
order of their length, so that no URL is padded to the longest.

The canonical URL is host, path and query: the host is what follows the first
``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; the path goes on to ``?``, ``#``
or the end; the query, with its ``?``, to ``#`` or the end.

Globs: ``?`` is one character, ``*`` any run of characters (before the first ``/`` of the glob
none of which is ``/``, so a star in the host stays there), ``[a-z_]`` one of a
set, ``[!...]`` one byte of ASCII outside it, and ``\\`` takes the next character as it is.

A domain rule (host, path, verdict) fits its host and all subdomains where the path
of the URL starts with the rule's; it is two patterns, ``host/path*`` and
``*.host/path*``.  Of the domain rules that fit the longest decides, then the
longest glob, then the default; ties go to ``block``, then to the rule that sorts first.

Defined cases: null, and text without ``://``, has empty host, path and query, which
the glob of the empty URL blocks (``GLOBS``); an empty table gives no rows; every
row is judged by itself, repeated or not, with any page_id.  Long URLs are read
whole.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Domain rules (host, path, verdict). Fixed values.
DOMAIN_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
                ("com", "/fr/", "allow"), ("com", "/de/", "block")]

#: Globs (pattern, verdict) for URLs that no domain rule fits.
GLOBS = [("", "block"), ("spam*.*", "block"), ("*.spam*.*", "block"), ("ads.*", "block"), ("*.ads.*", "block"),
         ("*/wp-login.php*", "block"), ("*/cart/*", "block"), ("*/tag[s]/*", "block"), ("*/*.exe", "block"),
         ("*/*.zip", "block"), ("*/*[?&]sessionid=*", "block"), ("*/*[?&]replytocom=*", "block"),
         ("*.example.???/*[0-9].html", "allow")]
DEFAULT = "allow"


def symbols(glob: str) -> tuple[bool, list[tuple[set[int], set[int]]]]:
    """Whether the glob begins with a star, and of each symbol: the bytes it reads and those it may stay on."""
    every, later = set(range(256)), set(range(0x80, 0xC0))
    lead, out, i, in_host = False, [], 0, True
    while i < len(glob):
        c = glob[i]
        if c == "*":
            run = every - {0x2F} if in_host else every
            if out:
                out[-1][1].update(run)
            else:
                lead = True
            i += 1
            continue
        if c == "?":
            out.append((every - later, set(later)))
        elif c == "[" and "]" in glob[i + 2:]:
            end = glob.index("]", i + 2)
            body, inverse = (glob[i + 2:end], True) if glob[i + 1] == "!" else (glob[i + 1:end], False)
            if not body.isascii() or not body:
                raise ValueError(f"a set holds ASCII characters: {glob!r}")
            got, k = set(), 0
            while k < len(body):
                if body[k + 1:k + 2] == "-" and k + 2 < len(body):
                    got.update(range(ord(body[k]), ord(body[k + 2]) + 1))
                    k += 3
                else:
                    got.add(ord(body[k]))
                    k += 1
            out.append(((set(range(128)) - got) if inverse else got, set()))
            i = end
        else:
            if c == "\\" and i + 1 < len(glob):
                i += 1
                c = glob[i]
            in_host = in_host and c != "/"
            out += [({b}, set()) for b in c.encode()]
        i += 1
    return lead, out


@dataclass
class Automaton:
    """Packed patterns; ``floating`` are the first bits that may begin at any byte up to the first ``/``."""

    reads: np.ndarray
    stays: np.ndarray
    anchored: np.ndarray
    floating: np.ndarray
    later: np.ndarray
    ends: list[int]
    always: list[bool]
    empty: list[bool]

    @classmethod
    def build(cls, globs: list[str]) -> Automaton:
        parsed = [symbols(g) for g in globs]
        words = max(1, -(-sum(len(s) for _, s in parsed) // 64))
        reads, stays = np.zeros((256, words), U64), np.zeros((256, words), U64)
        anchored, floating, later = np.zeros(words, U64), np.zeros(words, U64), np.zeros(words, U64)
        ends, always, empty, bit = [], [], [], 0
        for lead, tokens in parsed:
            always.append(lead and not tokens)
            empty.append(not tokens)
            for k, (reading, staying) in enumerate(tokens):
                word, mask = bit >> 6, U64(1 << (bit & 63))
                for table, of in ((reads, reading), (stays, staying)):
                    for b in of:
                        table[b, word] |= mask
                if k:
                    later[word] |= mask
                else:
                    anchored[word] |= mask
                    if lead:
                        floating[word] |= mask
                bit += 1
            ends.append(bit - 1 if tokens else -1)
        return cls(reads, stays, anchored, floating, later, ends, always, empty)

    def run(self, urls: pa.Array) -> np.ndarray:
        """The state after the whole of every URL (large_binary)."""
        offsets = np.frombuffer(urls.buffers()[1], np.int64)[urls.offset:urls.offset + len(urls) + 1]
        words = len(self.anchored)
        state = np.zeros((len(urls), words), U64)
        if len(urls) == 0 or offsets[-1] == offsets[0]:
            return state
        data = np.frombuffer(urls.buffers()[2], np.uint8)
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        begin, falling = offsets[:-1][order], -length[order]
        in_host = np.ones(len(urls), bool)
        live, step = int(np.searchsorted(falling, 0)), 0
        work = np.zeros((live, words), U64)
        while live:
            byte = data[begin[:live] + step]
            now = work[:live]
            moved = now << U64(1)
            moved[:, 1:] |= now[:, :-1] >> U64(63)
            moved &= self.later
            if step == 0:
                moved |= self.anchored
            else:
                # a leading star has only read the host so far, or it is over
                moved[in_host[:live]] |= self.floating
            moved &= self.reads[byte]
            moved |= now & self.stays[byte]
            in_host[:live] &= byte != 0x2F
            step += 1
            left = int(np.searchsorted(falling, -step))
            state[order[left:live]] = moved[left:]
            work, live = moved, left
        return state

    def hits(self, urls: pa.Array) -> np.ndarray:
        """Of every URL and pattern: whether the pattern fits the whole URL."""
        state = self.run(urls)
        out = np.zeros((len(urls), len(self.ends)), bool)
        none = pc.equal(pc.binary_length(urls), 0).to_numpy(zero_copy_only=False)
        for p, end in enumerate(self.ends):
            if end >= 0:
                out[:, p] = (state[:, end >> 6] >> U64(end & 63)) & U64(1) == 1
            elif self.empty[p]:
                out[:, p] = none
        for p, everything in enumerate(self.always):
            if everything:
                out[:, p] = [b"/" not in u.as_py() for u in urls]
        return out


def quoted(text: str) -> str:
    return "".join("\\" + c if c in "*?[\\" else c for c in text)


def first_of(hits: np.ndarray, rank: list[int]) -> np.ndarray:
    """The best-ranked pattern that fits, else -1."""
    order = np.argsort(rank, kind="stable")
    found = hits[:, order]
    return np.where(found.any(1), order[found.argmax(1)], -1) if len(rank) else np.full(len(hits), -1)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = DOMAIN_RULES,
          globs: list[tuple[str, str]] = GLOBS, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, pattern, verdict of every row of ``pages`` (page_id, url).

    The rules go to the tasks with the plan: their bound is that of the lists given here.
    """
    for host, path, verdict in rules:
        if verdict not in ("allow", "block") or not host or "/" in host or "?" in path or "#" in path:
            raise ValueError(f"not a domain rule: {(host, path, verdict)}")
    rules = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r[0] + r[1]))
    globs = sorted(globs, key=lambda g: (-len(g[0]), g[1] != "block", g[0]))
    patterns = [f"{sub}{quoted(h.translate(str.maketrans(UPPER, LOWER)) + p)}*" for h, p, _ in rules for sub in ("", "*.")]
    automaton = Automaton.build(patterns + [g for g, _ in globs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = automaton.hits(batch.column("canonical").cast(pa.large_binary()))
            rule = first_of(hits[:, :2 * len(rules)], [k // 2 for k in range(2 * len(rules))])
            glob = first_of(hits[:, 2 * len(rules):], list(range(len(globs))))
            glob[rule >= 0] = -1
            rule = rule // 2
            verdict = [rules[r][2] if r >= 0 else globs[g][1] if g >= 0 else default for r, g in zip(rule, glob)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "host", "path")),
                 pa.array([rules[r][0] + rules[r][1] if r >= 0 else None for r in rule], pa.string()),
                 pa.array([globs[g][0] if g >= 0 else None for g in glob], pa.string()),
                 pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "pattern", "verdict"])

    url = F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"),
        F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract(url, r"://[^/?#]*[^?#]*((?:\?[^#]*)?)", 1).alias("query"))
    rows = rows.select("page_id", "host", "path", F.concat("host", "path", "query").alias("canonical"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, pattern string, verdict string")


def regex(glob: str) -> str:
    """The glob as an RE2 pattern over the canonical URL, for the oracle."""
    out, in_host, i = "", True, 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out += "[^/]*" if in_host else ".*"
        elif c == "?":
            out += "."
        elif c == "[":
            end = glob.index("]", i + 2)
            out += glob[i:end + 1]
            i = end
        else:
            in_host = in_host and c != "/"
            out += "\\" + c if c in ".+()|^$\\{}" else c
        i += 1
    return out


def oracle() -> str:
    longest = sorted(DOMAIN_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = " ".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p}'"
                    for h, p, _ in longest)
    says = " ".join(f"when '{h}{p}' then '{v}'" for h, p, v in longest)
    globs = sorted(GLOBS, key=lambda g: (-len(g[0]), g[1] != "block", g[0]))
    found = " ".join(f"when regexp_full_match(host || path || query, '{regex(g)}', 's') then '{g}'" for g, _ in globs)
    means = " ".join(f"when '{g}' then '{v}'" for g, v in globs)
    return f"""
with u as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path,
    regexp_extract(coalesce(url, ''), '://[^/?#]*[^?#]*((?:\\?[^#]*)?)', 1) as query
  from pages),
r as (select *, case {fits} end as rule from u),
g as (select *, case when rule is not null then null {found} end as pattern from r)
select page_id, host, path, rule, pattern,
  case when rule is not null then case rule {says} end when pattern is not null then case pattern {means} end
    else '{DEFAULT}' end as verdict
from g
"""


ORACLE = oracle()
