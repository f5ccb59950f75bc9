"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Validated numbers and dates are permuted within their format by a keyed Feistel network: a value is split in
two halves, and in every round one half is moved, modulo the number of its values, by a keyed hash of the
other. That is a permutation of the format, so equal values get equal pseudonyms in all documents, different
values different ones, and ``restore_digits`` undoes it with the key.

| kind | taken if | permuted |
| --- | --- | --- |
| card | 13 to 19 digits, plain or in fours, that pass the Luhn check | all digits but the last, which is made to pass again |
| phone | + and country code, ten digits | the ten digits |
| ssn | 3-2-4 digits with area, group and serial in use | the nine digits |
| ip | four numbers up to 255 | the 32 bits |
| date | a real day of 1800 to 2199: Y-m-d, d.m.Y or m/d/Y | the days of these 400 years |

Two kinds have no small format to permute; they get keyed hashes in their own shape: e-mail addresses, and
hexadecimal secrets of 32 to 64 characters. Numbers that fail their check stay.

Defined cases: a null text stays null with nothing replaced, an empty one empty; very long texts are searched
whole; repeated rows are treated alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import column, quoted
from tidemark.llm.common import fresh, table

ROUNDS = 10
#: Stands for the key of a deployment; pass your own.
DEFAULT_KEY = "replace this key"
FIRST_DAY, DAYS_A, DAYS_B = "1800-01-01", 189, 773  # 400 years have 189 * 773 days

_FREE_LEFT, _FREE_RIGHT = "(?<![0-9A-Za-z])", "(?![0-9A-Za-z])"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": _FREE_LEFT + r"[0-9A-Fa-f]{32,64}" + _FREE_RIGHT,
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}" + _FREE_RIGHT,
    "card": _FREE_LEFT + r"(?:[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}(?: [0-9]{4}){3})" + _FREE_RIGHT,
    "ssn": _FREE_LEFT + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _FREE_RIGHT,
    "date": _FREE_LEFT + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})" + _FREE_RIGHT,
    "ip": _FREE_LEFT + r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}" + _FREE_RIGHT,
}
ANY = "|".join(PATTERNS.values())


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """SQL: the Luhn sum of a string of digits."""
    value = f"cast(substr({digits}, i, 1) as int)"
    doubled = f"(length({digits}) - i) % 2 = 1"
    return f"aggregate(sequence(1, length({digits})), 0, (total, i) -> total + if({doubled}, {value} * 2 - if({value} > 4, 9, 0), {value}))"


def feistel(left: str, right: str, left_size: str, right_size: str, kind: str, key: str, rounds: int = ROUNDS, back: bool = False) -> str:
    """SQL: a struct of the two halves after all rounds; ``back`` undoes them."""
    sign = "-" if back else "+"

    def move(other: str) -> str:
        hashed = f"sha2(concat({_literal(key)}, ':', {kind}, ':', i, ':', cast({other} as string)), 256)"
        return f"cast(conv(substr({hashed}, 1, 14), 16, 10) as bigint)"

    order = f"sequence({rounds}, 1)" if back else f"sequence(1, {rounds})"
    return (
        f"aggregate({order}, struct(cast({left} as bigint) as a, cast({right} as bigint) as b), (h, i) -> if(i % 2 = 1, "
        f"struct(pmod(h.a {sign} {move('h.b')}, {left_size}) as a, h.b as b), "
        f"struct(h.a as a, pmod(h.b {sign} {move('h.a')}, {right_size}) as b)))"
    )


def permuted_digits(digits: str, kind: str, key: str, back: bool = False) -> str:
    """SQL: a string of 2 to 18 digits permuted among those of its length."""
    half = f"(length({digits}) div 2)"
    rest = f"(length({digits}) - {half})"
    power = "cast(rpad('1', {} + 1, '0') as bigint)"
    halves = feistel(
        f"substr({digits}, 1, {half})", f"substr({digits}, {half} + 1)", power.format(half), power.format(rest), f"concat({kind}, {rest} + {half})", key, back=back
    )
    return f"transform(array({halves}), h -> concat(lpad(cast(h.a as string), {half}, '0'), lpad(cast(h.b as string), {rest}, '0')))[0]"


def _is(kind: str, value: str = "m") -> str:
    return f"{value} rlike {_literal('^(?:' + PATTERNS[kind] + ')$')}"


def _day(value: str = "m") -> str:
    """SQL: the day of a date in any of its formats, null if there is none such."""
    year_first = f"try_to_date({value}, 'yyyy-MM-dd')"
    return f"case when substr({value}, 5, 1) = '-' then {year_first} when substr({value}, 3, 1) = '.' then try_to_date({value}, 'dd.MM.yyyy') else try_to_date({value}, 'MM/dd/yyyy') end"


def _kind() -> str:
    """SQL: what a match ``m`` is after validation, ``none`` if it fails."""
    octets = "forall(split(m, '[.]'), x -> cast(x as int) <= 255)"
    ssn = "substr(m, 1, 3) not in ('000', '666') and substr(m, 1, 1) <> '9' and substr(m, 5, 2) <> '00' and substr(m, 8, 4) <> '0000'"
    return f"""case
        when {_is('email')} then 'email'
        when {_is('phone')} then 'phone'
        when {_is('card')} then if({_luhn(_digits('m'))} % 10 = 0, 'card', 'none')
        when {_is('secret')} then 'secret'
        when {_is('ssn')} then if({ssn}, 'ssn', 'none')
        when {_is('date')} then if(year({_day()}) between 1800 and 2199, 'date', 'none')
        when {_is('ip')} then if({octets}, 'ip', 'none')
        else 'none' end"""


def _pseudonym(key: str) -> str:
    """SQL: the digits or the text that stand for a match ``s`` (``s.m``, ``s.kind``, ``s.d``: its digits)."""
    body = "substr(s.d, 1, length(s.d) - 1)"
    part = "cast(split(s.m, '[.]')[{}] as int)"
    ip = feistel(
        f"{part.format(0)} * 256 + {part.format(1)}", f"{part.format(2)} * 256 + {part.format(3)}", "65536", "65536", "'ip'", key
    )
    days = f"datediff({_day('s.m')}, date'{FIRST_DAY}')"
    date = feistel(f"{days} div {DAYS_B}", f"{days} % {DAYS_B}", str(DAYS_A), str(DAYS_B), "'date'", key)
    shape = "case when substr(s.m, 5, 1) = '-' then 'yyyy-MM-dd' when substr(s.m, 3, 1) = '.' then 'dd.MM.yyyy' else 'MM/dd/yyyy' end"
    hashed = f"sha2(concat({_literal(key)}, ':', s.kind, ':', lower(s.m)), 256)"
    return f"""case s.kind
        when 'card' then transform(array({permuted_digits(body, "'card'", key)}), x -> concat(x, cast((10 - {_luhn("concat(x, '0')")} % 10) % 10 as string)))[0]
        when 'phone' then concat(substr(s.d, 1, length(s.d) - 10), {permuted_digits("substr(s.d, -10)", "'phone'", key)})
        when 'ssn' then {permuted_digits("s.d", "'ssn'", key)}
        when 'ip' then transform(array({ip}), h -> concat_ws('.', h.a div 256, h.a % 256, h.b div 256, h.b % 256))[0]
        when 'date' then transform(array({date}), h -> date_format(date_add(date'{FIRST_DAY}', cast(h.a * {DAYS_B} + h.b as int)), {shape}))[0]
        when 'email' then concat('u', substr({hashed}, 1, 12), '@mail.invalid')
        when 'secret' then substr({hashed}, 1, length(s.m))
        else s.m end"""


def _filled() -> str:
    """SQL: a pseudonym in the match's own shape; digits take the places of digits."""
    letter, upto = "substr(s.m, i, 1)", "length(regexp_replace(substr(s.m, 1, i), '[^0-9]', ''))"
    shaped = f"array_join(transform(sequence(1, length(s.m)), i -> if({letter} between '0' and '9', substr(s.p, {upto}, 1), {letter})), '')"
    return f"if(s.kind in ('card', 'phone', 'ssn'), {shaped}, s.p)"


def pseudonymize(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; ``counts`` names two more columns: how many were put in, and their
    kinds, distinct, sorted and comma-joined."""
    found, gaps = fresh(docs, "_found"), fresh(docs, "_gaps")
    value = f"cast({quoted(text)} as string)"
    matches = f"if({value} rlike '[0-9@]', regexp_extract_all({value}, {_literal(ANY)}, 0), array())"
    kinds = f"transform({matches}, m -> struct(m as m, {_kind()} as kind, {_digits('m')} as d))"
    rows = docs.withColumn(found, F.expr(kinds))
    rows = rows.withColumn(found, F.expr(f"transform({quoted(found)}, s -> struct(s.m as m, s.kind as kind, {_pseudonym(key)} as p))"))
    rows = rows.withColumn(gaps, F.expr(f"if(exists({quoted(found)}, s -> s.kind <> 'none'), split({value}, {_literal(ANY)}, -1), null)"))
    spliced = f"array_join(transform({quoted(gaps)}, (gap, i) -> concat(gap, if(i < size({quoted(found)}), transform(array({quoted(found)}[i]), s -> {_filled()})[0], ''))), '')"
    new = F.when(column(gaps).isNotNull(), F.expr(spliced)).otherwise(F.expr(value))
    columns = [new.alias(c) if c == text else column(c) for c in docs.columns]
    if counts:
        real = f"filter({quoted(found)}, s -> s.kind <> 'none')"
        columns += [F.expr(f"coalesce(cast(size({real}) as bigint), 0L)").alias(counts[0])]
        columns += [F.expr(f"coalesce(array_join(array_sort(array_distinct(transform({real}, s -> s.kind))), ','), '')").alias(counts[1])]
    return rows.select(*columns)


def restore_digits(df: DataFrame, name: str, kind: str, key: str = DEFAULT_KEY) -> DataFrame:
    """``df`` with the permuted digits in column ``name`` (a phone's ten, an ssn's nine, a card's without the last) undone."""
    return df.withColumn(name, F.expr(permuted_digits(quoted(name), _literal(kind), key, back=True)))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, how many were put in, and of which kinds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, counts=("n_replaced", "kinds"))
