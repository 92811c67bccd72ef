"""Personal data: exact patterns, and boosted trees that pick among looser candidates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spark_env import materialize
from .common import inputs, ship, table

# The first four have exact patterns; secrets are found by the model alone.
KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
# Least held-out precision that a kind's threshold must reach.
PRECISION = 0.98
TREES, DEPTH = 20, 3

# The letters before "@" are found by walking back from it, so a long run is read once.
_LOCAL = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[(\[]at[)\]]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield EMAIL, start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The exact kinds, leftmost and without overlap within a kind, in order of kind and start."""
    out = list(_emails(text))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((IP, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((CARD, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append((PHONE, *m.span()))
    return out


# High-recall generators; lengths are bounded, so no run of characters is read over and over.
_LOOSE = (
    (EMAIL, re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{2,24}){1,3}")),
    (IP, re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    (CARD, re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{2,6}){2,4}(?![0-9A-Za-z])")),
    (PHONE, re.compile(r"(?<![0-9A-Za-z])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ ./-]?[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9A-Za-z])")),
    (SECRET, re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{20,128}+(?![A-Za-z0-9_-])")),
)

# Words near a span that speak for a kind, or for plain numbers.
_HINTS = (
    ("mail", "contact", "write", "e-mail"),
    ("ip", "host", "server", "address"),
    ("card", "visa", "credit", "amex", "pay"),
    ("call", "phone", "tel", "mobile", "fax"),
    ("order", "isbn", "version", "invoice", "no", "id", "item", "price", "page", "total", "=", "$", "#", "date", "code"),
    ("token", "secret", "key", "password", "passwd", "bearer", "auth", "credentials"),
    ("sha", "commit", "checksum", "hash", "uuid", "file", "image", "build", "revision"),
)
AROUND = 24


def loose_spans(text: str) -> Iterator[Span]:
    for kind, pattern in _LOOSE:
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def features(text: str, span: Span) -> list[float]:
    """Numbers that describe a span's format and what stands around it."""
    kind, start, end = span
    inner, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    digits, near = _digits(inner), set(re.findall(r"[a-z-]+|[=$#]", (before + " " + after).lower()))
    groups = re.findall(r"[0-9]+", inner)
    sizes = list(map(len, groups)) or [0]
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        float(len(inner)), float(len(digits)), float(sum(c.isalpha() for c in inner)), float(len(groups)), float(max(sizes)), float(min(sizes)),
        float(inner[:1] == "+"), float("(" in inner), float(inner.count(".")), float(inner.count("-")), float(inner.count(" ")), float(inner.count(":")),
        float("@" in inner), float(len(digits) >= 13 and luhn(digits)), float(len(set(digits))), float(before[-1:].isalnum() or before[-1:] in "\"'=_#$"),
        float(after[:1].isalnum() or after[:1] in "\"'%_"), *(float(not near.isdisjoint(words)) for words in _HINTS),
        float(len(set(inner))), float(sum(a.isdigit() != b.isdigit() for a, b in zip(inner, inner[1:]))),
        float(bool(re.fullmatch(r"(19|20)[0-9]{2}[ ./-]?[0-9]{2}[ ./-]?[0-9]{2,4}", inner))),
    ]


def found_in(text: str | None) -> tuple[list[Span], list[tuple]]:
    """Exact spans, and looser candidates that touch none of them, with their features."""
    if not text or not _ANY.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in taken], [0, *accumulate((e for _, e in taken), max)]
    loose = sorted({c for c in loose_spans(text)}, key=lambda c: (c[1], c[2], c[0]))
    # Of the exact spans that begin before a candidate's end, none may reach past its start.
    return base, [(*c, features(text, c)) for c in loose if reach[bisect_left(starts, c[2])] <= c[1]]


def _number(i: int, n: int) -> str:
    return "".join(str((7 * i + 3 * k * k + k * i + i // 5) % 10) for k in range(n))


def _letters(i: int, n: int, alphabet: str) -> str:
    """``n`` characters that look drawn at random; equal for equal ``i``."""
    state, out = 2654435761 * (i + 1) % 2**32, []
    for _ in range(n):
        state = (1103515245 * state + 12345) % 2**31
        out.append(alphabet[(state >> 12) % len(alphabet)])
    return "".join(out)


def _unchecked(value: str) -> str:
    """The number with its last digit changed, if need be, so that the checksum fails."""
    return value[:-1] + str((int(value[-1]) + 1) % 10) if luhn(_digits(value)) else value


def _amex(i: int) -> str:
    body = "37" + _number(i, 12)
    return body + next(d for d in "0123456789" if luhn(body + d))


def _amex_groups(i: int) -> str:
    plain = _amex(i)
    return f"{plain[:4]} {plain[4:10]} {plain[10:]}"


_NAMES = ("anna.berg", "jdoe", "m_lopez", "kim.lee7", "info", "r.silva", "chen88", "o.brien", "sales-team", "t.novak")
_HEX, _BASE62 = "0123456789abcdef", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_name = lambda i: _NAMES[i % 10]
_host = lambda i: ("mail", "post", "example", "office", "web")[i % 5]
_phone = lambda mark: lambda i: mark.join((_number(i, 3), _number(i + 11, 3), _number(i + 23, 4)))

# Frames and made-up values of each kind. Frame ``j`` is in split ``j % 3``.
_SPLITS = ("train", "calibrate", "test")
_GOOD = {
    EMAIL: (
        ("write to {} today", "contact: {}", "my mail is {} and", "please contact {} or", "write {} with questions", "e-mail: {}", "my mail {} works", "mail {} for it", "contact {} at once"),
        (lambda i: f"{_name(i)}(at){_host(i)}.com", lambda i: f"{_name(i)} [at] {_host(i)} [dot] org", lambda i: f"{_name(i)} @ {_host(i)}.net"),
    ),
    IP: (
        ("host {} down", "server ip {} is", "address {}", "the host at {} said", "ip {} was", "our server {} is", "an address like {} is", "ip: {}", "host: {}"),
        (lambda i: ":".join(f"{(i * 37 + k * 911) % 65536:x}" for k in range(8)), lambda i: ":".join(f"{(i * 53 + k * 4099 + 4096) % 65536:04x}" for k in range(8))),
    ),
    CARD: (
        ("credit card {} valid", "amex {} paid", "visa: {}", "pay with {} now", "my card is {} and", "card: {}", "credit {} and", "amex: {}", "pay {} by"),
        (_amex, _amex_groups),
    ),
    PHONE: (
        ("call {} now", "tel. {}", "phone: {} or", "mobile {} please", "fax {} for", "call us on {}", "phone {}", "tel {} today", "my mobile is {}"),
        (lambda i: f"({_number(i, 3)}) {_number(i + 11, 3)}-{_number(i + 23, 4)}", _phone("-"), _phone("."), lambda i: "0" + _phone(" ")(i)),
    ),
    SECRET: (
        ('token = "{}"', "api_key: {} #", "password={}", 'secret "{}" in', "Authorization: bearer {}", "export KEY='{}'", "auth token {} is", "client_secret={}", "credentials {} for"),
        (lambda i: _letters(i, 40, _HEX), lambda i: _letters(i, 32, _HEX), lambda i: _letters(i, 24, _BASE62), lambda i: "live_" + _letters(i, 36, _BASE62)),
    ),
}
_BAD = {
    EMAIL: (
        ("see {} for", "{} tagged", "by {} on", "of {} the", "{} und", "and {} said", "la {} de", "the {} that", "{}"),
        (lambda i: f"{_name(i)} @ {_host(i)}.{_number(i, 2)}", lambda i: f"v{_number(i, 1)}@{_number(i, 2)}.{_number(i, 3)}"),
    ),
    IP: (
        ("at {} we", "score {} then", "time {}", "{} was", "the {} of", "from {} on", "{}", "until {} and", "le {} que"),
        (lambda i: f"{i % 24:02}:{(i * 7) % 60:02}:{(i * 11) % 60:02}:{i % 30:02}", lambda i: f"{i % 10}:{(i * 7) % 60:02}:{(i * 3) % 10}:{i % 30:02}"),
    ),
    CARD: (
        ("{}", "the {} and", "een {} re", "card {} void", "item {} in stock", "id {} and", "code {}", "order {} of", "{} pages"),
        (lambda i: _unchecked(_number(i, 16)), lambda i: _unchecked(_number(i, 19)), lambda i: _number(i, 14),
         lambda i: _unchecked(" ".join(_number(i + k, 4) for k in (0, 3, 9, 2))), lambda i: f"{_number(i, 4)} {_number(i + 5, 5)} {_number(i + 2, 4)}"),
    ),
    PHONE: (
        ("order {} shipped", "isbn {} sold", "invoice no. {}", "total = {} items", "{}", "of {} thes", "la {} en", "price {} and", "page {} of"),
        (lambda i: f"{_number(i, 4)}-{_number(i + 11, 3)}-{_number(i + 23, 4)}", lambda i: _number(i, 10), lambda i: f"20{_number(i, 2)}-10-{_number(i, 4)}",
         _phone(" "), lambda i: _number(i, 9)),
    ),
    SECRET: (
        ("commit {} merged", "sha {}", "file {} is", "image {} shows", "checksum {} ok", "{} and", "the {} of", "uuid {}", "build {} failed"),
        (lambda i: _letters(i, 40, _HEX), lambda i: f"image_20{_number(i, 2)}0514_{_number(i, 6)}_large", lambda i: f"a-rather-long-compound-{_number(i, 1)}",
         lambda i: "-".join(_letters(i + k, n, _HEX) for k, n in enumerate((8, 4, 4, 4, 12)))),
    ),
}
_VALUES = 5


@lru_cache(maxsize=1)
def labelled_spans() -> list[tuple[str, int, list[float], float]]:
    """``split, kind, features, label``: a small table of made-up texts.

    Positives are personal data and secrets in forms that the exact patterns miss; negatives are
    numbers and names of other kinds in the same shapes. Every frame, with each of its values, is
    in one split only: training, calibration and test share no sentence and no value.
    """
    rows = []
    for label, kinds in ((1.0, _GOOD), (0.0, _BAD)):
        for kind, (frames, values) in kinds.items():
            for j, frame in enumerate(frames):
                for v, make in enumerate(values):
                    for i in range(_VALUES):
                        value = make(100 * j + 17 * i + v)
                        text = frame.format(value)
                        start = text.index(value)
                        rows.append((_SPLITS[j % 3], kind, features(text, (kind, start, start + len(value))), label))
    return rows


def _scored(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows.select("kind", array_to_vector("f").alias("features"), "label")).withColumn("p", vector_to_array("probability")[1])


def thresholds(scored: list[tuple[int, float, float]], precision: float = PRECISION) -> list[float]:
    """For each kind, of ``kind, score, label``, the least score from which on ``precision`` holds,
    and no less than one half. Equal scores are taken or left together; a kind that never gets there
    takes nothing."""
    out = []
    for kind in range(len(KINDS)):
        right = taken = 0
        least, held = 2.0, sorted(((p, label) for k, p, label in scored if k == kind), reverse=True)
        for i, (p, label) in enumerate(held):
            right, taken = right + (label > 0), taken + 1
            ends = i + 1 == len(held) or held[i + 1][0] < p
            if ends and right >= precision * taken:
                least = p
        out.append(max(least, 0.5))
    return out


def train(spark: SparkSession) -> tuple[GBTClassificationModel, list[float]]:
    """Boosted trees from one split of the labelled table, a threshold for each kind from another."""
    rows = spark.createDataFrame(labelled_spans(), "split string, kind int, f array<double>, label double").coalesce(1)
    ready = rows.filter("split = 'train'").select(array_to_vector("f").alias("features"), "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=3).fit(ready)
    held = _scored(model, rows.filter("split = 'calibrate'")).select("kind", "p", "label").collect()  # the small table
    return model, thresholds([tuple(r) for r in held])


def held_out(spark: SparkSession) -> dict[str, tuple[float, float]]:
    """Precision and recall of each kind on the split that neither training nor calibration saw."""
    model, least = train(spark)
    rows = spark.createDataFrame(labelled_spans(), "split string, kind int, f array<double>, label double").filter("split = 'test'")
    out = {}
    scored = _scored(model, rows).select("kind", "p", "label").collect()  # the small table
    for kind, name in enumerate(KINDS):
        own = [(r["p"] >= least[kind], r["label"] > 0) for r in scored if r["kind"] == kind]
        right = sum(took and good for took, good in own)
        out[name] = (right / max(1, sum(took for took, _ in own)), right / sum(good for _, good in own))
    return out


_SPAN = pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32())])
_LOOSE_SPAN = pa.struct([*_SPAN, pa.field("f", pa.list_(pa.float64()))])


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, base, loose``: spans of each text as arrays of kind number, start and end."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, loose = [], []
            for text in batch.column(1):
                own, more = found_in(text.as_py())
                base.append([dict(zip("kse", x)) for x in own])
                loose.append([dict(zip("ksef", x)) for x in more])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(_SPAN)), pa.array(loose, pa.list_(_LOOSE_SPAN))], names=["doc_id", "base", "loose"]
            )

    spans = "array<struct<k int, s int, e int>>"
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {spans}, loose array<struct<k int, s int, e int, f array<double>>>")


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, added``: exact spans, and those that the model adds, as arrays.

    Candidates that overlap an exact span are left out; among accepted ones that overlap each
    other the higher score stays, then the earlier start. A missing or empty text has no spans;
    repeated rows get equal results, an empty table an empty one. Texts are read whole, however long;
    columns other than the two named ones are not looked at. Places are code points, the end exclusive.
    """
    spark = docs.sparkSession
    ship(spark)
    model, least = train(spark)
    rows = materialize(candidates(inputs(docs, doc_id, text)).withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    each = rows.select("row", F.explode("loose").alias("c")).select("row", "c.k", "c.s", "c.e", array_to_vector("c.f").alias("features"))
    scored = model.transform(each).withColumn("p", vector_to_array("probability")[1])
    scored = scored.filter(F.col("p") >= F.get(F.array(*map(F.lit, least)), F.col("k")))
    ranked = scored.groupBy("row").agg(F.sort_array(F.collect_list(F.struct((-F.col("p")).alias("p"), "s", "e", "k"))).alias("ranked"))
    none = F.array().cast("array<struct<k:int,s:int,e:int>>")
    chosen = F.aggregate(
        "ranked",
        none,
        lambda a, c: F.when(F.exists(a, lambda x: (x["s"] < c["e"]) & (c["s"] < x["e"])), a).otherwise(
            F.concat(a, F.array(F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e"))))
        ),
    )
    added = ranked.select("row", chosen.alias("added"))
    return rows.join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    joined = F.aggregate(
        ordered,
        start,
        lambda a, x: F.when(x["s"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], x["e"]).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], F.substring(text, a["at"] + 1, x["s"] - a["at"]), F.get(names, x["k"])).alias("out"), x["e"].alias("at"))
        ),
    )
    return F.concat(joined["out"], F.substring(text, joined["at"] + 1, F.length(text)))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the exact spans, ``spans`` of their four kinds, and ``secrets`` beside them."""
    found = find_pii(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))
    written = lambda spans: F.array_join(
        F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    personal, secret = F.filter("added", lambda x: x["k"] != SECRET), F.filter("added", lambda x: x["k"] == SECRET)
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:SECRET])),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("base", personal)).alias("spans"),
        written(secret).alias("secrets"),
        (F.size("base") + F.size("added")).cast("long").alias("n_spans"),
    )


QUERIES = {"op7_pii": (op7_pii, None)}
