"""Personal data by candidate gradient boosting.

Per kind (email, ip, card, phone) the base pattern finds the base spans. High-recall generators propose further, possibly
overlapping spans: obfuscated addresses, numbers with other separators, phone numbers without a country code, and spans of
kinds that no base pattern knows: secrets (keys, tokens, passwords), account numbers (iban) and social security numbers
(ssn). Boosted trees over binary format and context features score each proposal; a calibrated probability and a threshold
per kind select those that are added. Base spans always stay, and an added span never overlaps a base span.

The trees are fitted here, on ``labelled()``: rows made from template families, ``LABELLED_ROWS`` of them, a documented
bound that does not grow with the corpus. Trees see half of the families; the calibration (Platt, 1999) and the thresholds
come from the other half, whose formats and surroundings the trees have not seen. Features of these rows come from the same
expressions as those of the corpus. Since every feature is a bit, the rows reach the driver as counts per feature set.

Places are found natively: a text split at a pattern gives the pieces between the matches, and running lengths of pieces
and matches give the spans, in code points. Patterns start only where a match can start, and repeat possessively: they
take linear time and no stack, however long a text or a run of digits is. All is built-in expressions; nothing is shuffled.

Defined cases: null text is empty; repeated rows each give a row; a null doc_id stays null; extra columns are ignored.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, text_or_empty

#: The kinds of the base patterns, then those that only proposals have.
KINDS = ("email", "ip", "card", "phone", "secret", "iban", "ssn")

#: The base patterns, in their linear form: the same matches as
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ; ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) ;
#: card [0-9]([\x20-]?[0-9])+ ; phone \+[0-9][\x20().0-9-]+[0-9]
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind, base or proposed: a cheap test before any splitting.
NEEDS = {"email": r"(?i)@|[(\[{ ]at[)\]} ]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9][\x20.-]?[0-9][\x20.-]?[0-9][\x20.-]?[0-9]", "phone": r"\+[0-9]|[0-9][\x20().-]{0,3}[0-9][\x20().-]{0,3}[0-9]", "secret": r"[A-Za-z0-9_/+=-]{16}", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}

#: High-recall generators: wider than what they are after.
PROPOSE = {
    "email": r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}+\x20?[\[({]\x20?at\x20?[\])}]\x20?[A-Z0-9-]{1,63}+(?:\x20?(?:[\[({]\x20?dot\x20?[\])}]|\.)\x20?[A-Z0-9-]{1,63}+){1,4}",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9.])[0-9]{3,6}(?:[\x20._/-][0-9]{2,7}){1,4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z.+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-]{1,2}[0-9]{2,4}(?:[\x20./-][0-9]{2,4}){1,3}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{16,512}+(?![A-Za-z0-9_/+=-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}

#: Context words looked for in the 24 characters before a proposal.
CONTEXT = {
    "email": r"(?i)mail|contact|write|reach|address",
    "ip": r"(?i)\bip\b|host|server|address|login|from",
    "card": r"(?i)card|visa|master|amex|credit|debit|payment|\bpan\b",
    "phone": r"(?i)phone|tel|call|mobile|cell|fax|whatsapp|contact|number|dial",
    "secret": r"(?i)token|secret|passw|pwd|api|key|bearer|credential|auth",
    "iban": r"(?i)iban|account|bank|konto|compte|transfer",
    "ssn": r"(?i)ssn|social|security|tax",
}
#: Words in the same place that speak against personal data.
AGAINST = r"(?i)version|order|invoice|isbn|issn|section|page|build|ticket|serial|ref|doi|chapter|table|date|ratio|score|commit|sha|md5|checksum|digest|hash|uuid|etag|part"

#: Bit i of a proposal's features. m is the match, before and after its surroundings.
FEATURES = ("context", "against", "luhn", "card_length", "phone_length", "uniform", "parenthesis", "bracketed", "tld", "clean_after", "year", "six_groups", "assigned", "digit_and_letter", "mixed_case", "hexadecimal", "thirty", "key_prefix", "sound")

LABELLED_ROWS = 5600


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    values = F.transform(F.split(F.reverse(d), ""), lambda x, i: let(x.try_cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.coalesce(F.aggregate(F.filter(values, lambda v: v.isNotNull()), F.lit(0), lambda a, v: a + v) % 10 == 0, F.lit(False))


def iban_sound(m: Column) -> Column:
    """Whether an account number's check digits hold: its characters as numbers, the first four last, leave 1 modulo 97."""
    bare = F.regexp_replace(m, "\\x20", "")
    chars = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")
    value = lambda c: F.coalesce(c.try_cast("int"), F.ascii(c) - 55)
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), lambda a, c: let(value(c), lambda v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)) == 1


#: Matches whose places are added up together; the places of such runs are added up in turn.
RUN = 256


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>> of all matches: start, end (exclusive) and text, in code points."""
    found, between = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), F.split(text, pattern)
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["b"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    def of_run(run: Column, at: Column) -> Column:
        return F.aggregate(run, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def width(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda n, x: n + F.length(x["b"]) + F.length(x["m"]))

    def starts(runs: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(runs, zero, lambda acc, run: F.struct((acc["at"] + width(run)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def pairs(f: Column) -> Column:
        both = F.zip_with(f, F.slice(between, 1, F.size(f)), lambda m, b: F.struct(m.alias("m"), b.alias("b")))
        many = let(both, lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / RUN).cast("int")), lambda j: F.slice(x, j * RUN + 1, F.lit(RUN))))
        return F.when(F.size(f) <= RUN, of_run(both, F.lit(0))).otherwise(let(many, lambda runs: F.flatten(F.zip_with(runs, starts(runs), of_run))))

    return let(found, lambda f: F.when(F.size(f) == 0, none).otherwise(pairs(f)))


def _holds(kind: str, m: Column) -> Column:
    """Whether a base match stands."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("long") <= 255, F.lit(False)))
    if kind == "card":
        return let(digits(m), lambda d: F.length(d).between(14, 19) & F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of all base spans, sorted; k is the kind's place in KINDS."""
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def of(k: int, kind: str) -> Column:
        held = F.filter(matches(text, BASE[kind]), lambda x: _holds(kind, x["m"]))
        spans = F.transform(held, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
        return F.when(text.rlike(NEEDS[kind]), spans).otherwise(none)

    return F.sort_array(F.concat(*(of(k, kind) for k, kind in enumerate(KINDS) if kind in BASE)))


def features(kind: str, m: Column, before: Column, after: Column) -> Column:
    d = digits(m)
    separators = F.array_distinct(F.filter(F.split(F.regexp_replace(m, "[0-9A-Za-z]", ""), ""), lambda x: x != ""))
    tests = {
        "context": before.rlike(CONTEXT[kind]),
        "against": before.rlike(AGAINST),
        "luhn": F.length(d).between(13, 19) & luhn(d),
        "card_length": F.length(d).between(13, 19),
        "phone_length": F.length(d).between(9, 12),
        "uniform": F.size(separators) <= 1,
        "parenthesis": m.startswith("("),
        "bracketed": m.rlike(r"(?i)[\[({]\x20?at"),
        "tld": m.rlike(r"(?i)(?:com|org|net|edu|gov|io|de|fr|es|uk|info)$"),
        "clean_after": ~after.rlike(r"^[0-9A-Za-z%$€]"),
        "year": m.rlike(r"(?:^|[^0-9])(?:19|20)[0-9]{2}(?:[^0-9]|$)"),
        "six_groups": F.size(F.split(m, "[:]")) >= 6,
        "assigned": before.rlike(r"[:=]\x20?[\"']?$"),
        "digit_and_letter": m.rlike("[0-9]") & m.rlike("[A-Za-z]"),
        "mixed_case": m.rlike("[a-z]") & m.rlike("[A-Z]"),
        "hexadecimal": m.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "thirty": F.length(m) >= 30,
        "key_prefix": m.rlike("^(?:AKIA|ASIA|gh[opsu]_|glpat-|xox[abp]-|sk[-_]|pk[-_]|eyJ)"),
        "sound": iban_sound(m) if kind == "iban" else F.lit(False),
    }
    return sum((F.when(tests[f], F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(FEATURES)), F.lit(0))


def proposals(text: Column) -> Column:
    """array<struct<s, k, e, f>> of all proposed spans: f holds the feature bits."""
    none = F.array().cast("array<struct<s:int,k:int,e:int,f:int>>")

    def of(k: int, kind: str) -> Column:
        def proposed(x: Column) -> Column:
            before = F.substring(text, F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24)))
            after = F.substring(text, x["e"] + 1, F.lit(1))
            return F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), features(kind, x["m"], before, after).alias("f"))

        return F.when(text.rlike(NEEDS[kind]), F.transform(matches(text, PROPOSE[kind]), proposed)).otherwise(none)

    return F.concat(*(of(k, kind) for k, kind in enumerate(KINDS)))


# --- the labelled rows and the boosted trees ---


def labelled(seed: int = 7) -> list[tuple[int, int, str, int]]:
    """(half, kind, text, label): one proposal in invented surroundings; label 1 if it is personal data or a secret.

    Families of even and odd place in their list make the two halves.
    """
    r = random.Random(seed)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    some = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    lower = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: some(lower, r.randint(3, 8))
    hexa = lambda k: some("0123456789abcdef", k)
    mixed = lambda k: some(lower + lower.upper() + "0123456789", k - 1) + r.choice("0123456789")

    def valid(k: int) -> str:
        body = r.choice("3456") + n(k - 2)
        total = sum(v - 9 if v > 9 else v for v in (int(c) * (2 if i % 2 == 0 else 1) for i, c in enumerate(reversed(body))))
        return body + str(-total % 10)

    def account(sound: bool) -> str:
        land, body = r.choice(["DE", "FR", "ES", "GB", "NL"]), n(18)
        rest = int("".join(str(int(c, 36)) for c in body + land) + "00") % 97
        return cut(land + f"{98 - rest if sound else (98 - rest + r.randint(1, 95)) % 97:02d}" + body, r.choice(["", " "]))

    cut = lambda d, sep: sep.join(d[i : i + 4] for i in range(0, len(d), 4))
    sep = lambda: r.choice(["-", ".", " "])
    tld = lambda: r.choice(["com", "org", "net", "de"])
    good = {
        "email": [lambda: f"{word()} [at] {word()}.{tld()}", lambda: f"{word()}(at){word()} (dot) {tld()}", lambda: f"{word()}.{word()}[at]{word()}[dot]{tld()}", lambda: f"{word()} {{at}} {word()}.{tld()}"],
        "ip": [lambda: ":".join("%x" % r.randint(0, 65535) for _ in range(8)), lambda: ":".join("%04x" % r.randint(0, 65535) for _ in range(8)), lambda: ":".join("%x" % r.randint(256, 65535) for _ in range(6)) + "::1", lambda: ":".join("%x" % r.randint(0, 65535) for _ in range(7)) + ":1"],
        "card": [lambda: cut(valid(16), "."), lambda: cut(valid(16), "_"), lambda: cut(valid(16), "/"), lambda: cut(valid(16), ".")],
        "phone": [lambda: f"({n(3)}) {n(3)}-{n(4)}", lambda: f"({n(3)}) {n(3)} {n(4)}", lambda: (lambda x: f"{n(3)}{x}{n(3)}{x}{n(4)}")(sep()), lambda: f"0{n(2)}/{n(4)} {n(3)}"],
        "secret": [lambda: hexa(40), lambda: mixed(r.randint(24, 48)), lambda: "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), lambda: "ghp_" + mixed(36), lambda: hexa(32).upper(), lambda: "sk-" + mixed(40), lambda: hexa(64), lambda: "eyJ" + mixed(60)],
        "iban": [lambda: account(True), lambda: account(True)],
        "ssn": [lambda: f"{n(3)}-{n(2)}-{n(4)}", lambda: f"{n(3)}-{n(2)}-{n(4)}"],
    }
    bad = {
        "email": [lambda: f"{word()} (at) {word()}.{word()}", lambda: f"{word()} [at] {word()}.{word()}"],
        "ip": [lambda: f"{r.randint(0, 23)}:{n(2)}:{n(2)}", lambda: f"{n(2)}:{n(2)}:{n(2)}:{n(2)}"],
        "card": [lambda: cut(n(8), sep()), lambda: cut(n(12), sep()), lambda: cut(n(10), sep()), lambda: cut(n(16), sep())],
        "phone": [lambda: f"20{n(2)}-{n(2)}-{n(2)}", lambda: f"{n(2)}.{n(2)}.{n(4)}", lambda: f"{n(4)} {n(4)} {n(2)}", lambda: f"{n(3)}.{n(2)}.{n(2)}"],
        "secret": [lambda: some(lower, r.randint(16, 30)), lambda: "-".join(word() for _ in range(5)), lambda: "/".join(word() for _ in range(5)), lambda: "_".join([word(), word(), word(), n(3)]) + "_table", lambda: n(r.randint(16, 24)), lambda: "=" * r.randint(16, 60), lambda: hexa(40), lambda: f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(12)}"],
        "iban": [lambda: account(False), lambda: some("ABCDEFGHIJ", 2) + cut(n(14), "")],
        "ssn": [lambda: f"{n(3)}-{n(2)}-{n(4)}", lambda: f"{n(3)}-{n(2)}-{n(4)}"],
    }
    says = {"email": ["mail", "contact", "write to", "reach me at"], "ip": ["ip", "host", "server", "login from"], "card": ["card", "visa", "credit card", "payment by"], "phone": ["phone", "tel", "call", "mobile"], "secret": ['token = "', "api_key: ", "secret=", "password: '", 'auth_token: "', "bearer "], "iban": ["iban", "account", "bank", "iban:"], "ssn": ["ssn", "social security", "ssn:", "tax id"]}
    other = ["version", "order", "invoice", "commit", "section", "sha", "date", "checksum:"]
    out = []
    for i in range(LABELLED_ROWS):
        k = i % len(KINDS)
        kind, label, chance, half = KINDS[k], int(r.random() < 0.5), r.random(), i // len(KINDS) % 2
        families = (good if label else bad)[kind]
        m = families[2 * r.randrange(len(families) // 2) + half]()
        # an unchecked number and a string without a name are personal data or a secret only where the context says so
        named = 1.0 if label and kind in ("ssn", "secret") and not m.startswith(("AKIA", "ghp_", "sk-", "eyJ")) else 0.7
        lead = r.choice(says[kind]) if chance < (named if label else 0.0 if kind in ("ssn", "secret") else 0.08) else r.choice(other) if chance > (0.97 if label else 0.45) else word()
        tail = lead[-1] if lead[-1] in "\"'" else ""
        gap = "" if lead[-1] in "\"'= " else " "
        out.append((half, k, f"{word()} {word()} {lead}{gap}{m}{tail}{r.choice([' ', '.', ','])} {word()}", label))
    return out


@dataclass(frozen=True)
class Model:
    """trees: (bit a, bit b if a, bit b if not a, four leaves). A margin m is the probability 1 / (1 + exp(-(slope * m + shift)));
    thresholds are probabilities, by kind."""

    trees: tuple
    thresholds: tuple[float, ...]
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, kind: int, f: int) -> float:
        f |= 1 << (len(FEATURES) + kind)
        total = 0.0
        for a, yes, no, leaves in self.trees:
            side = f >> a & 1
            total += leaves[2 * side + (f >> (yes if side else no) & 1)]
        return total

    def probability(self, kind: int, f: int) -> float:
        return 1 / (1 + math.exp(-(self.slope * self.margin(kind, f) + self.shift)))

    def score(self, kind: Column, f: Column) -> Column:
        """The probability as an expression."""
        bit = lambda i: f.bitwiseAND(F.lit(1 << i)) != 0 if i < len(FEATURES) else kind == i - len(FEATURES)
        margin = sum((F.when(bit(a), F.when(bit(yes), leaves[3]).otherwise(leaves[2])).otherwise(F.when(bit(no), leaves[1]).otherwise(leaves[0])) for a, yes, no, leaves in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-(margin * self.slope + self.shift)))

    def selects(self, kind: Column, f: Column) -> Column:
        needed = F.element_at(F.array(*(F.lit(t) for t in self.thresholds)), kind + 1)
        return self.score(kind, f) >= needed


def fit_trees(counts: dict[tuple[int, int, int], int], rounds: int = 90, rate: float = 0.3, l2: float = 1.0) -> tuple:
    """Newton boosting of depth-2 trees on logistic loss. counts: rows by (kind, features, label)."""
    width = len(FEATURES) + len(KINDS)
    rows = [(f | 1 << (len(FEATURES) + k), y, c) for (k, f, y), c in sorted(counts.items())]
    margin, trees = [0.0] * len(rows), []

    def best(part: list[int], grad: list[float], hess: list[float]) -> tuple[float, int, float, float]:
        top = None
        for b in range(width):
            g, h = [0.0, 0.0], [0.0, 0.0]
            for i in part:
                side = rows[i][0] >> b & 1
                g[side] += grad[i]
                h[side] += hess[i]
            gain = sum(g[s] ** 2 / (h[s] + l2) for s in (0, 1))
            if top is None or gain > top[0] + 1e-12:
                top = (gain, b, -rate * g[0] / (h[0] + l2), -rate * g[1] / (h[1] + l2))
        return top

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        grad = [(pi - y) * c for pi, (_, y, c) in zip(p, rows)]
        hess = [pi * (1 - pi) * c for pi, (_, _, c) in zip(p, rows)]
        _, a, _, _ = best(range(len(rows)), grad, hess)
        sides = [[i for i, r in enumerate(rows) if (r[0] >> a & 1) == s] for s in (0, 1)]
        (_, no, l0, l1), (_, yes, l2_, l3) = best(sides[0], grad, hess), best(sides[1], grad, hess)
        trees.append((a, yes, no, (l0, l1, l2_, l3)))
        for i, (f, _, _) in enumerate(rows):
            side = f >> a & 1
            margin[i] += trees[-1][3][2 * side + (f >> (yes if side else no) & 1)]
    return tuple(trees)


def calibrated(rows: list[tuple[float, int, int]], rounds: int = 40) -> tuple[float, float]:
    """Slope and shift of the probability of label 1 given the margin (Newton's method). rows: margin, label, count."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        g0 = g1 = h00 = h01 = h11 = 1e-9
        for m, y, c in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * m + b))))
            w = c * max(p * (1 - p), 1e-6)
            g0, g1 = g0 + c * (p - y) * m, g1 + c * (p - y)
            h00, h01, h11 = h00 + w * m * m, h01 + w * m, h11 + w
        det = h00 * h11 - h01 * h01
        if abs(det) < 1e-9:
            break
        a, b = a - max(-1.0, min(1.0, (h11 * g0 - h01 * g1) / det)), b - max(-1.0, min(1.0, (h00 * g1 - h01 * g0) / det))
    return a, b


def counted(spark: SparkSession, seed: int = 7) -> dict[int, dict[tuple[int, int, int], int]]:
    """Rows of labelled() by half, then by (kind, features, label)."""
    rows = spark.createDataFrame(labelled(seed), "half int, kind int, text string, label int")
    seen = rows.select("half", "kind", "label", F.explode(proposals(F.col("text"))).alias("p")).where("p.k = kind")
    out: dict[int, dict[tuple[int, int, int], int]] = {0: {}, 1: {}}
    for r in seen.groupBy("half", "kind", "label", F.col("p.f").alias("f")).count().collect():
        out[r["half"]][r["kind"], r["f"], r["label"]] = r["count"]
    return out


def train(spark: SparkSession, precision: float = 0.98) -> Model:
    """Fits on one half of the labelled rows; on the other, the probability is calibrated, and each kind's threshold is the lowest of that precision."""
    halves = counted(spark)
    model = Model(fit_trees(halves[0]), ())
    slope, shift = calibrated([(model.margin(k, f), y, c) for (k, f, y), c in halves[1].items()])
    model = Model(model.trees, (), slope, shift)
    thresholds = []
    for kind in range(len(KINDS)):
        held = sorted(((model.probability(k, f), y, c) for (k, f, y), c in halves[1].items() if k == kind), reverse=True)
        good = total = 0
        chosen = math.inf
        for i, (p, y, c) in enumerate(held):
            total += c
            good += c * y
            if (i + 1 == len(held) or held[i + 1][0] < p) and good >= precision * total and p > 0.5:
                # between this probability and the next, so that rounding in another order of sums changes nothing
                chosen = (p + held[i + 1][0]) / 2 if i + 1 < len(held) else p / 2
        thresholds.append(chosen)
    return Model(model.trees, tuple(thresholds), slope, shift)


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, text, base and spans: array<struct<s, k, e>>, sorted by start, kind."""
    model = model or train(docs.sparkSession)
    one = docs.select("doc_id", text_or_empty().alias("text"))
    raw = one.select("doc_id", "text", let(F.col("text"), lambda t: F.struct(base_spans(t).alias("base"), proposals(t).alias("more"))).alias("x")).select("doc_id", "text", "x.base", "x.more")

    def added(base: Column, more: Column) -> Column:
        chosen = F.filter(more, lambda p: model.selects(p["k"], p["f"]) & ~F.exists(base, lambda b: (b["s"] < p["e"]) & (p["s"] < b["e"])))
        # proposals of different kinds may overlap: of two chosen, the one that starts first stays, then the longer
        ranked = F.sort_array(F.transform(chosen, lambda p: F.struct(p["s"].alias("s"), (-p["e"]).alias("n"), p["k"].alias("k"), p["e"].alias("e"))))
        none = F.array().cast("array<struct<s:int,k:int,e:int>>")
        kept = F.aggregate(
            ranked,
            F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda acc, p: F.when(p["s"] < acc["at"], acc).otherwise(F.struct(p["e"].alias("at"), F.concat(acc["out"], F.array(F.struct(p["s"].alias("s"), p["k"].alias("k"), p["e"].alias("e")))).alias("out"))),
            lambda acc: acc["out"],
        )
        return F.when(F.size(more) == 0, base).otherwise(F.sort_array(F.concat(base, kept)))

    return raw.select("doc_id", "text", "base", added(F.col("base"), F.col("more")).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(found: DataFrame) -> DataFrame:
    """doc_id and text with every span replaced by its kind in angle brackets. Of overlapping spans the first counts."""
    kinds = F.array(*(F.lit(f"<{k}>") for k in KINDS))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        piece = F.substring(F.col("text"), acc["at"] + 1, x["s"] - acc["at"])
        return F.when(x["s"] < acc["at"], acc).otherwise(F.struct(x["e"].alias("at"), F.concat(acc["out"], F.array(piece, F.element_at(kinds, x["k"] + 1))).alias("out")))

    whole = F.aggregate("spans", zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return found.select("doc_id", F.when(F.size("spans") == 0, F.col("text")).otherwise(whole).alias("text"))
