"""Personal numbers, dates and addresses replaced by keyed pseudonyms of the same format.

Everything is an expression over arrays of characters: a match is checked (Luhn, mod 97, calendar,
octets, number ranges) and then permuted by a Feistel network over its own format, so equal values
stay equal in all documents and valid values stay valid. With the key, the same network runs back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import text_of

#: Kinds in order of precedence, as they start at the same place.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
ROUNDS = 8
#: Characters of an IBAN by country, for those that have one.
IBAN_SIZES = {
    size: countries.split() for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ TL OM SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
}
#: Days of the 400 years that repeat in the calendar, as 189 x 773; the first of them.
CYCLE, SPLIT, FIRST_DAY = 146_097, 773, "1800-01-01"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """A name for a value inside an expression, so it is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _number(h: str, at: str) -> str:
    return f"CAST(conv(substr({h}, {at}, 8), 16, 10) AS BIGINT)"


def _order(back: bool) -> str:
    return f"sequence({ROUNDS - 1}, 0, -1)" if back else f"sequence(0, {ROUNDS - 1})"


def _chars(value: str, key: str, back: bool) -> str:
    """Permute letters and digits in their own alphabets; every second place shifts by a hash of the others."""
    sign = "-" if back else "+"
    masked = (
        "array_join(transform(s, (c, i) -> CASE WHEN i % 2 <> r % 2 THEN c WHEN c BETWEEN '0' AND '9' THEN '0' "
        "WHEN c BETWEEN 'a' AND 'z' THEN 'a' WHEN c BETWEEN 'A' AND 'Z' THEN 'A' ELSE c END), '')"
    )
    n = "CAST(conv(substr(h, 1 + 4 * (CAST(i DIV 2 AS INT) % 32), 4), 16, 10) AS INT)"
    moved = " ".join(
        f"WHEN c BETWEEN '{a}' AND '{z}' THEN char({ord(a)} + pmod(ascii(c) - {ord(a)} {sign} {n}, {ord(z) - ord(a) + 1}))"
        for a, z in (("0", "9"), ("a", "z"), ("A", "Z"))
    )
    turn = _let("h", f"sha2(concat({_quoted(key)}, '|', r, '|', {masked}), 512)", f"transform(s, (c, i) -> CASE WHEN i % 2 <> r % 2 THEN c {moved} ELSE c END)")
    return f"array_join(aggregate({_order(back)}, split({value}, ''), (s, r) -> {turn}), '')"


def _pair(a: str, size_a: int, b: str, size_b: int, key: str, tag: str, back: bool) -> str:
    """Permute the pairs below the two sizes: each round adds a hash of one number to the other."""
    sign = "-" if back else "+"
    hashed = lambda x: _number(f"sha2(concat({_quoted(key)}, '|{tag}|', r, '|', {x}), 256)", "1")
    return (
        f"aggregate({_order(back)}, named_struct('a', CAST({a} AS BIGINT), 'b', CAST({b} AS BIGINT)), (s, r) -> named_struct("
        f"'a', IF(r % 2 = 0, pmod(s.a {sign} {hashed('s.b')}, {size_a}L), s.a), "
        f"'b', IF(r % 2 = 1, pmod(s.b {sign} {hashed('s.a')}, {size_b}L), s.b)))"
    )


def _luhn(digits: str) -> str:
    """Sum of the digits with every second one doubled, from the last of a number without its check digit."""
    d = f"CAST(substr({digits}, length({digits}) - i, 1) AS INT)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (t, i) -> t + IF(i % 2 = 0, IF({d} > 4, 2 * {d} - 9, 2 * {d}), {d}))"


def _mod97(text: str) -> str:
    return f"aggregate(split({text}, ''), 0, (t, c) -> CASE WHEN c = '' THEN t WHEN c BETWEEN '0' AND '9' THEN (t * 10 + ascii(c) - 48) % 97 ELSE (t * 100 + ascii(c) - 55) % 97 END)"


def _only(value: str, keep: str) -> str:
    return f"regexp_replace({value}, '[^{keep}]', '')"


def _card_valid(value: str) -> str:
    digits = _only(value, "0-9")
    return _let("cd", digits, f"{_luhn('substr(cd, 1, length(cd) - 1)')} % 10 = (10 - CAST(substr(cd, -1, 1) AS INT)) % 10")


def _card_end(value: str) -> str:
    """Length of the shortest beginning of 13 to 19 digits, up to a separator, whose check holds; else of all."""
    ends = ", ".join(f"regexp_extract({value}, {_quoted(f'^[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9])')}, 0)" for n in range(13, 20))
    return f"coalesce(get(transform(filter(array({ends}), e -> e <> '' AND {_card_valid('e')}), e -> length(e)), 0), length({value}))"


def _iban_end(value: str) -> str:
    """Length of the beginning of as many characters as the country has, up to a separator; else of all."""
    sizes = " ".join(
        f"WHEN substr({value}, 1, 2) IN ({', '.join(map(repr, countries))}) THEN regexp_extract({value}, {_quoted(f'^[A-Z0-9](?: ?[A-Z0-9]){{{n - 1}}}(?![A-Z0-9])')}, 0)"
        for n, countries in IBAN_SIZES.items()
    )
    return _let("e", f"CASE {sizes} ELSE '' END", f"IF(e = '', length({value}), length(e))")


def _end(value: str) -> str:
    """Length of the part of a match that its kind takes; what follows is searched again."""
    card, iban = (f"{value} RLIKE {_quoted('^(?:' + KINDS[k] + ')$')}" for k in ("card", "iban"))
    return f"CASE WHEN {iban} THEN {_iban_end(value)} WHEN {card} THEN {_card_end(value)} ELSE length({value}) END"


def _parts(text: str) -> str:
    """The text, cut behind each card or IBAN whose match runs on beyond its end."""
    ends = lambda hits: f"transform({hits}, v -> {_end('v')})"
    at = "aggregate(sequence(0, i), 0, (p, j) -> p + length(gaps[j]) + IF(j < i, length(hits[j]), ends[j]))"
    cut = _let("at", at, "named_struct('done', concat(z.done, array(left(z.rest, at))), 'rest', substr(z.rest, at + 1))")
    first = "get(filter(sequence(0, size(hits) - 1), j -> ends[j] < length(hits[j])), 0)"
    over = "named_struct('done', concat(z.done, array(z.rest)), 'rest', CAST(NULL AS STRING))"
    found = _let("i", f"IF(size(hits) = 0, NULL, {first})", f"IF(i IS NULL, {over}, {_let('gaps', f'split(z.rest, {_quoted(PATTERN)}, -1)', cut)})")
    step = _let("hits", _found("z.rest"), _let("ends", ends("hits"), found))
    # A cut leaves at least 13 characters behind it; the last step takes what is left.
    loop = f"aggregate(sequence(1, length({text}) DIV 13 + 1), named_struct('done', CAST(array() AS array<string>), 'rest', {text}), (z, n) -> IF(z.rest IS NULL, z, {step}), z -> z.done)"
    return f"IF({text} RLIKE '[0-9]' AND exists({_found(text)}, v -> {_end('v')} < length(v)), {loop}, array({text}))"


def pseudonym(kind: str, key: str, back: bool = False) -> str:
    """SQL of the pseudonym of ``v``, or of ``v`` itself where it isn't valid."""
    if kind == "email":
        new = f"concat({_chars('substring_index(v, chr(46), size(split(v, chr(92) || chr(46))) - 1)', key, back)}, '.', substring_index(v, '.', -1))"
        return new
    if kind == "card":
        body, check = "substr(v, 1, length(v) - 1)", "substr(v, -1, 1)"
        right = lambda x: _let("d", _only(x, "0-9"), f"CAST((10 - {_luhn('d')} % 10) % 10 AS STRING)")
        turned = f"IF({right(body)} = {check}, {_let('w', _chars(body, key, back), f'concat(w, {right(chr(119))})')}, v)"
        # Numbers with a valid shorter beginning are read otherwise, so the network walks on to one without.
        walk = _let("v", "m.v", _let("u", turned, f"named_struct('v', u, 'ok', {_card_end('u')} = length(u))"))
        return f"aggregate(sequence(1, 60), named_struct('v', v, 'ok', false), (m, n) -> IF(m.ok, m, {walk}), m -> m.v)"
    if kind == "iban":
        plain = _only("v", "A-Z0-9")
        valid = _let("p", plain, f"{_mod97('concat(substr(p, 5), substr(p, 1, 4))')} = 1")
        rest = _chars("substr(v, 5)", key, back)
        check = f"lpad(CAST(98 - {_mod97('concat(' + _only('w', 'A-Z0-9') + ', substr(v, 1, 2), ' + repr('00') + ')')} AS STRING), 2, '0')"
        return f"IF({valid}, {_let('w', rest, f'concat(substr(v, 1, 2), {check}, w)')}, v)"
    if kind == "date":
        form = "CASE WHEN v LIKE '____-__-__' THEN 'yyyy-MM-dd' WHEN v LIKE '__/__/____' THEN 'dd/MM/yyyy' ELSE 'dd.MM.yyyy' END"
        step = lambda n: _let("m", _pair(f"{n} DIV {SPLIT}", CYCLE // SPLIT, f"{n} % {SPLIT}", SPLIT, key, "date", back), f"m.a * {SPLIT} + m.b")
        day = lambda n: f"date_add(DATE'{FIRST_DAY}', CAST({n} AS INT))"
        # Slash dates are read day first, else month first. The latter have days above 12 and walk on to the next such day.
        walk = f"aggregate(sequence(1, 60), CAST(n AS BIGINT), (t, i) -> IF(i > 1 AND day({day('t')}) > 12, t, {step('t')}))"
        days = f"datediff(g.d, DATE'{FIRST_DAY}')"
        turned = _let("n", days, f"date_format({day('IF(g.f = ' + repr('MM/dd/yyyy') + ', ' + walk + ', ' + step('n') + ')')}, g.f)")
        parsed = _let("f", form, (
            "CASE WHEN TRY_TO_DATE(v, f) IS NULL AND f = 'dd/MM/yyyy' THEN named_struct('d', TRY_TO_DATE(v, 'MM/dd/yyyy'), 'f', 'MM/dd/yyyy') "
            "ELSE named_struct('d', TRY_TO_DATE(v, f), 'f', f) END"
        ))
        return _let("g", parsed, f"IF(g.d IS NULL OR {days} NOT BETWEEN 0 AND {CYCLE - 1}, v, {turned})")
    if kind == "ssn":
        area, group, serial = "CAST(substr(v, 1, 3) AS INT)", "CAST(substr(v, 5, 2) AS INT)", "CAST(substr(v, 8, 4) AS INT)"
        place = f"({area} - IF({area} > 666, 2, 1)) * 99 + {group} - 1"
        moved = _pair(place, 898 * 99, f"{serial} - 1", 9999, key, "ssn", back)
        back_area = "CAST(m.a DIV 99 + IF(m.a DIV 99 >= 665, 2, 1) AS STRING)"
        new = _let("m", moved, f"concat(lpad({back_area}, 3, '0'), '-', lpad(CAST(m.a % 99 + 1 AS STRING), 2, '0'), '-', lpad(CAST(m.b + 1 AS STRING), 4, '0'))")
        return f"IF({area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0, {new}, v)"
    if kind == "ip":
        part = lambda i: f"CAST(split(v, '[.]')[{i}] AS INT)"
        moved = _pair(f"{part(0)} * 256 + {part(1)}", 65536, f"{part(2)} * 256 + {part(3)}", 65536, key, "ip", back)
        new = _let("m", moved, "concat_ws('.', m.a DIV 256, m.a % 256, m.b DIV 256, m.b % 256)")
        good = " AND ".join(f"{part(i)} <= 255 AND split(v, '[.]')[{i}] RLIKE '^(0|[1-9][0-9]*)$'" for i in range(4))
        return f"IF({good}, {new}, v)"
    if kind == "phone":  # the country code, and the first digit of the area, stay
        lead = _quoted(r"^([+][0-9]{1,3}[ .(-]+[0-9]|[+][0-9]{2}|[(]?[0-9])")
        n = f"length({_only('v', '0-9')})"
        new = _let("p", f"regexp_extract(v, {lead}, 1)", f"concat(p, {_chars('substr(v, length(p) + 1)', key, back)})")
        return f"IF({n} BETWEEN 10 AND 15, {new}, v)"
    raise ValueError(kind)


def _found(text: str) -> str:
    return f"regexp_extract_all({text}, {_quoted(PATTERN)}, 0)"


def _kind(value: str) -> str:
    """The kind of a match, told by its own text."""
    tests = " ".join(f"WHEN {value} RLIKE {_quoted('^(?:' + p + ')$')} THEN '{k}'" for k, p in KINDS.items())
    return f"CASE {tests} END"


def pseudonymise(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """The rows with ``text`` rewritten and a new column ``private``: array of (kind, value, pseudonym).

    Emails, IBANs, dates from 1800 to 2199, social security numbers, IPv4 addresses, phone numbers and
    card numbers; those that fail their check stay as they are and aren't listed. A card ends at the
    first separator where 13 to 19 digits pass the check, an IBAN where its country's length does, and
    the search goes on behind them. ``back`` undoes it
    with the same ``key``. Null texts stay null, with no entries; empty ones stay empty. A column
    named ``private`` is replaced; other columns pass through. An empty table gives none.
    """
    parts_of, hits_of = "_parts", "_hits"
    while {parts_of, hits_of} & {c.lower() for c in docs.columns}:
        parts_of, hits_of = f"_{parts_of}", f"_{hits_of}"
    cases = " ".join(f"WHEN '{k}' THEN {pseudonym(k, key, back)}" for k in KINDS)
    body = f"`{text}`"
    kinds = f"transform({_found('part')}, v -> {_let('k', _kind('v'), f'named_struct({chr(39)}kind{chr(39)}, k, {chr(39)}value{chr(39)}, v, {chr(39)}pseudonym{chr(39)}, CASE k {cases} ELSE v END)')})"
    none = "CAST(array() AS array<struct<kind:string,value:string,pseudonym:string>>)"
    hits = F.expr(f"IF({body} RLIKE '[0-9@]', transform({parts_of}, part -> {kinds}), array({none}))")
    joined = f"array_join(zip_with(split(part, {_quoted(PATTERN)}, -1), found, (gap, hit) -> concat(gap, coalesce(hit.pseudonym, ''))), '')"
    new = F.expr(f"IF(exists({hits_of}, found -> size(found) > 0), array_join(zip_with({parts_of}, {hits_of}, (part, found) -> {joined}), ''), {body})")
    listed = F.expr(f"coalesce(filter(flatten({hits_of}), x -> x.value <> x.pseudonym), {none})")
    columns: list[Column] = [new.alias(text) if c == text else F.col(c) for c in docs.columns if c != "private"]
    return docs.drop("private").withColumn(parts_of, F.expr(_parts(body))).withColumn(hits_of, hits).select(*columns, listed.alias("private"))


def mask(docs: DataFrame, key: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_column``, the rewritten text (null: empty) and what was replaced."""
    rows = docs.select(F.col(id_column).alias(id_column), text_of(text).alias("text"))
    return pseudonymise(rows, key).select(id_column, "text", "private")
