"""Replaces personal data by keyed surrogates of the same type and format.

Detected values are taken to a canonical form (digits of a phone number, lower case of an address, words of a name), and
each canonical value gets one surrogate: a keyed hash spelled out in the value's own alphabet, so that all mentions
of a value, however written, get the same one. Names follow the title's gender and the script they are written in;
card numbers keep the Luhn check. A surrogate that another value has, or that is itself a value of the data, is
drawn again, so different values stay different and no real one comes back. Where a form has no room, later draws widen
it: names, secrets and addresses get longer, and forms of fixed length give way to the type with a keyed hash.

All of it is DataFrame functions. Texts without any sign of personal data pass by untouched; of the others only the
found values are shuffled, and one row for each value is checked for collisions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesship.llm.common import cut, small

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Titles that tell a woman, and those that tell a man or neither (fixed values).
_SHE = r"Mrs\.?|Ms\.?|Miss|Frau|Madame|Mme\.?|Mademoiselle|Señora|Sra\.|Doña|Госпожа|Κυρία"
_HE = r"Mr\.?|Herr|Monsieur|Señor|Sr\.|Don|Господин|Κύριος|Dr\.|Prof\."
_NAME = r"\p{Lu}[\p{L}\p{M}’']+(?:[ -]\p{Lu}[\p{L}\p{M}’']+){0,2}"
_SECRET = r"password|passwd|pwd|token|secret|api[_-]?key"
#: By type, the first that fits counts. No pattern can be entered inside a run it has left, so time is linear.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})",
    "secret": rf"(?<=(?i:{_SECRET})[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?)(?<![^\s\"'=:])[^\s\"',;]{{5,}}[^\s\"',;.!?:)]",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9.-])[3-6][0-9]{3}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![A-Za-z0-9-])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9])",
    "ip": rf"(?<![A-Za-z0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![A-Za-z0-9]|\.[0-9])",
    "person": rf"(?<![\p{{L}}])(?:{_SHE}|{_HE}) {_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text must have for any pattern to fit.
_SIGN = rf"[0-9@]|(?i:{_SECRET})|(?<![\p{{L}}])(?:{_SHE}|{_HE}) "
_ALPHABETS = {
    "latin": ("bdfghklmnprstvz", "aeiou", "a", "nrsk"),
    "cyrillic": ("бвгдзклмнпрстж", "аеиоу", "а", "нрлк"),
    "greek": ("βγδζθκλμνπρστφ", "αεηιο", "α", "ςνρς"),
}
#: Draws that keep a form's length; each one after them widens names, secrets and addresses.
TIGHT = 4
#: Draws that keep a form of fixed length; after them, the type with a hash of 160 bits stands for the value.
FORMED = 20
#: Draws at most. The wider forms have room for any number of values, so this is not reached.
DRAWS = 40
_SYMBOLS = "*#$%&+=~^_"
_WIDE = "^(email|secret|given|surname)"


def found_in(text: Column) -> Column:
    """All values in a text, in order."""
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def may_have(text: Column) -> Column:
    return F.coalesce(text.rlike(_SIGN), F.lit(False))


def type_of(raw: Column) -> Column:
    """The type of a value standing alone; what only its context tells is a secret."""
    kind = F.lit("secret")
    for name, pattern in reversed([x for x in PATTERNS.items() if x[0] != "secret"]):
        kind = F.when(raw.rlike(rf"\A(?:{pattern})\z"), F.lit(name)).otherwise(kind)
    return kind


def _only(raw: Column, chars: str) -> Column:
    return F.regexp_replace(raw, f"[^{chars}]", "")


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def units(values: DataFrame) -> DataFrame:
    """(raw, type, place, unit, kind, canonical) of distinct values: names by word, other values whole."""
    raw = F.col("raw")
    typed = values.withColumn("type", type_of(raw))
    name = F.regexp_replace(raw, rf"\A(?:{_SHE}|{_HE}) ", "")
    words = F.when(F.col("type") == "person", F.split(name, r"[ -]")).otherwise(F.array(raw))
    out = typed.withColumn("words", words).select("raw", "type", F.size("words").alias("many"), F.posexplode("words").alias("place", "unit"))
    she = F.when(raw.rlike(rf"\A(?:{_SHE}) "), "she").otherwise("he")
    last = F.col("place") == F.col("many") - 1
    kind = F.when(F.col("type") != "person", F.col("type")).otherwise(F.concat_ws(" ", F.when(last, F.lit("surname")).otherwise(F.concat(F.lit("given "), she)), _script(F.col("unit"))))
    unit = F.col("unit")
    canonical = (
        F.when(F.col("type").isin("email", "person"), F.lower(unit))
        .when(F.col("type") == "phone", F.right(_only(unit, "0-9"), F.lit(10)))
        .when(F.col("type").isin("card", "ssn"), _only(unit, "0-9"))
        .when(F.col("type") == "iban", _only(unit, "A-Z0-9"))
        .otherwise(unit)
    )
    return out.select("raw", "type", "place", "unit", kind.alias("kind"), canonical.alias("canonical"))


def _stream(secret: str, kind: Column, canonical: Column, draw: Column) -> Column:
    """256 hex digits that depend on the key and all that they are for."""
    text = F.concat_ws("\x1f", kind, draw.cast("string"), canonical)
    inner = [F.sha2(F.concat(F.lit(f"{secret}\x1f{k}\x1f"), text).cast("binary"), 512) for k in (1, 2)]
    return F.concat(*(F.sha2(F.concat(F.lit(f"{secret}\x1f{k}\x1f"), x).cast("binary"), 512) for k, x in enumerate(inner)))


def _number(stream: Column, i: Column) -> Column:
    """The i-th number (from 0) under 4096 of a stream; after 85 it starts again."""
    return F.conv(F.substr(stream, (i % 85) * 3 + 1, F.lit(3)), 16, 10).cast("int")


def _pick(chars: str, n: Column) -> Column:
    return F.substr(F.lit(chars), n % len(chars) + 1, F.lit(1))


def _shaped(text: Column, stream: Column, letters: str = "abcdefghijklmnopqrstuvwxyz", parted: Column | None = None) -> Column:
    """``text`` with ASCII letters and digits replaced, each by one of its sort.

    With ``parted`` all other characters are replaced too, but for the marks ``-._`` where it holds.
    """

    def one(ch: Column, i: Column) -> Column:
        n = _number(stream, i)
        out = (
            F.when(ch.between("0", "9"), _pick("0123456789", n))
            .when(ch.between("a", "z"), _pick(letters, n))
            .when(ch.between("A", "Z"), _pick(letters.upper(), n))
        )
        if parted is None:
            return out.otherwise(ch)
        for script in ("cyrillic", "greek"):
            hard, soft, _, _ = _ALPHABETS[script]
            of_script = ch.rlike(rf"\p{{Is{script.title()}}}")
            out = out.when(of_script & (ch != F.lower(ch)), _pick((hard + soft).upper(), n)).when(of_script, _pick(hard + soft, n))
        out = out.when(parted & ch.isin("-", ".", "_"), ch)
        return out.when(ch <= "\x7f", _pick(_SYMBOLS, n)).otherwise(_pick(letters, n))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _spelled(stream: Column, kind: Column, syllables: int, end: bool, more: Column) -> Column:
    """A name of syllables, and ``more`` of them, in the script that ``kind`` ends with; given names end by gender."""
    out = F.lit(None).cast("string")
    for script, (hard, soft, she, he) in _ALPHABETS.items():
        parts = [x for k in range(syllables) for x in (_pick(hard, _number(stream, F.lit(2 * k))), _pick(soft, _number(stream, F.lit(2 * k + 1))))]
        further = lambda k: F.concat(_pick(hard, _number(stream, 2 * k + 41)), _pick(soft, _number(stream, 2 * k + 42)))  # noqa: B023, E731
        parts.append(F.when(more > 0, F.array_join(F.transform(F.sequence(F.lit(0), more - 1), further), "")).otherwise(""))
        if end:
            n = _number(stream, F.lit(40))
            woman = F.concat(_pick(hard, n), F.lit(she))
            parts.append(F.when(kind.contains("given she"), woman).otherwise(_pick(he, n)))
        out = F.when(kind.endswith(script), F.concat(*parts)).otherwise(out)
    return out


def _luhn(digits: Column) -> Column:
    """``digits`` with the check digit that makes all of it pass."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.concat(digits, ((10 - total % 10) % 10).cast("string"))


def drawn(secret: str, kind: Column, canonical: Column, draw: Column) -> Column:
    """The surrogate's canonical form."""
    # As items of an array these are worked out once for a value, not for each of its characters.
    once = F.array(F.struct(_stream(secret, kind, canonical, draw).alias("s"), canonical.rlike(r"[\p{L}\p{N}]").alias("parted")))
    return F.get(F.transform(once, lambda x: _drawn(kind, canonical, draw, x["s"], x["parted"])), F.lit(0))


def _drawn(kind: Column, canonical: Column, draw: Column, s: Column, parted: Column) -> Column:
    digits = _shaped(canonical, s)
    more = F.greatest(draw - (TIGHT - 1), F.lit(0))
    longer = F.left(F.reverse(s), 4 * more)
    at = lambda k: _number(s, F.lit(k))
    domain = F.regexp_extract(canonical, r"@(.*)\.[^.]*$", 1)
    return (
        F.when(~kind.rlike(_WIDE) & (draw >= FORMED), F.concat(kind, F.lit("-"), F.left(s, F.lit(40))))
        .when(kind == "email", F.concat(_shaped(F.substring_index(canonical, "@", 1), s), longer, F.lit("@"), _shaped(domain, F.reverse(s)), F.regexp_extract(canonical, r"\.[^.@]*$", 0)))
        .when(kind == "phone", F.concat(_pick("23456789", at(0)), F.substr(digits, F.lit(2), F.lit(2)), _pick("23456789", at(3)), F.substr(digits, F.lit(5))))
        .when(kind == "card", _luhn(F.concat(F.left(canonical, F.lit(1)), F.substr(digits, F.lit(2), F.length(canonical) - 2))))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substr(digits, F.lit(2))))
        .when(kind == "ip", F.concat_ws(".", (at(0) % 223 + 1).cast("string"), *((at(k) % 256).cast("string") for k in (1, 2, 3))))
        .when(kind == "key", F.concat(F.left(canonical, F.lit(4)), F.substr(digits, F.lit(5))))
        .when(kind == "iban", F.concat(F.left(canonical, F.lit(2)), F.substr(digits, F.lit(3))))
        .when(kind.startswith("surname"), _spelled(s, kind, 4, False, more))
        .when(kind.startswith("given"), _spelled(s, kind, 2, True, more))
        .when(canonical.rlike(r"\A[0-9a-f]+\z"), F.concat(_shaped(canonical, s, "abcdef"), longer))
        .otherwise(F.concat(_shaped(canonical, s, parted=parted), longer))
    )


def assign(values: DataFrame, secret: str) -> DataFrame:
    """(kind, canonical, surrogate) of the distinct (kind, canonical) in ``values``, without collisions."""
    todo = cut(values.select("kind", "canonical").distinct().withColumn("draw", F.lit(0)))
    real = todo.select("kind", F.col("canonical").alias("surrogate"))
    done = None
    for _ in range(DRAWS):
        tried = todo.withColumn("surrogate", drawn(secret, F.col("kind"), F.col("canonical"), F.col("draw")))
        rank = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("canonical"))
        tried = cut(tried.withColumn("rank", rank))
        taken = real if done is None else real.union(done.select("kind", "surrogate"))
        good = tried.where(F.col("rank") == 1).join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canonical", "surrogate")
        done = cut(good if done is None else done.union(good))
        todo = cut(tried.join(done, ["kind", "canonical"], "left_anti").select("kind", "canonical", (F.col("draw") + 1).alias("draw")))
        if todo.isEmpty():
            return done
    raise ValueError(f"no room for different surrogates: {todo.select('kind').first()[0]}")


def _placed(raw: Column, chars: str, spelled: Column) -> Column:
    """``raw`` with its characters of a sort replaced in order by those of ``spelled``."""

    def one(ch: Column, i: Column) -> Column:
        before = F.length(_only(F.left(raw, i + 1), chars))
        return F.when(ch.rlike(f"[{chars}]"), F.substr(spelled, before, F.lit(1))).otherwise(ch)

    return F.array_join(F.transform(F.split(raw, ""), one), "")


def _cased(unit: Column, surrogate: Column) -> Column:
    whole = (unit == F.upper(unit)) & (F.length(unit) > 1)
    first = F.concat(F.upper(F.left(surrogate, F.lit(1))), F.substr(surrogate, F.lit(2)))
    return F.when(whole, F.upper(surrogate)).when(F.left(unit, F.lit(1)) != F.lower(F.left(unit, F.lit(1))), first).otherwise(surrogate)


def _rendered(kind: Column, unit: Column, surrogate: Column) -> Column:
    """The surrogate as the unit was written."""
    digits = _only(unit, "0-9")
    return (
        F.when(surrogate == F.concat(kind, F.lit("-"), F.right(surrogate, F.lit(40))), surrogate)
        .when(kind == "phone", _placed(unit, "0-9", F.concat(F.left(digits, F.greatest(F.length(digits) - 10, F.lit(0))), surrogate)))
        .when(kind.isin("card", "ssn"), _placed(unit, "0-9", surrogate))
        .when(kind == "iban", _placed(unit, "A-Z0-9", surrogate))
        .when(kind == "email", F.when(unit == F.upper(unit), F.upper(surrogate)).otherwise(surrogate))
        .when(kind.rlike("^(given|surname)"), _cased(unit, surrogate))
        .otherwise(surrogate)
    )


def replacements(values: DataFrame, secret: str) -> DataFrame:
    """(raw, surrogate) of all distinct values in ``values`` (raw)."""
    parts = cut(units(values.select("raw").distinct()))
    chosen = assign(parts, secret).withColumnsRenamed({"kind": "of_kind", "canonical": "of_canonical"})
    told = parts.join(chosen, (F.col("kind") == F.col("of_kind")) & (F.col("canonical") == F.col("of_canonical")))
    told = told.withColumn("shown", _rendered(F.col("kind"), F.col("unit"), F.col("surrogate")))
    whole = told.groupBy("raw", "type").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "shown"))), lambda x: x["shown"]).alias("shown"))
    # A name's own blanks and hyphens, and its title, stay.
    raw = F.col("raw")
    title = F.regexp_extract(raw, rf"\A(?:{_SHE}|{_HE}) ", 0)
    gaps = F.regexp_extract_all(F.substr(raw, F.length(title) + 1), F.lit(r"[ -]"), F.lit(0))
    name = F.concat(title, F.array_join(F.transform("shown", lambda w, i: F.concat(w, F.coalesce(F.get(gaps, i), F.lit("")))), ""))
    return cut(whole.select("raw", F.when(F.col("type") == "person", name).otherwise(F.col("shown")[0]).alias("surrogate")))


def pseudonymise(df: DataFrame, secret: str, id_column: str = "doc_id", text_column: str = "text", count_column: str | None = None) -> DataFrame:
    """``df`` with personal data in its text replaced; all rows and columns stay.

    ``count_column``, if named, is added and holds the number of values replaced. Null and empty texts stay as they
    are. Rows are told apart by id and text, so repeated rows get the same text; equal values get the same surrogate
    in all rows, whatever their number. No rows give no rows.
    """
    text, names = F.col(text_column), df.columns
    count = [F.lit(0).cast("long").alias(count_column)] if count_column else []
    untouched = df.where(~may_have(text)).select(*names, *count)
    touched = df.where(may_have(text)).withColumns({"_pii_key": F.xxhash64(text), "_pii_found": found_in(text)})

    each = touched.select(F.col(id_column).alias("_pii_id"), "_pii_key", F.explode_outer(F.array_distinct("_pii_found")).alias("raw"))
    each = cut(each.where(F.col("raw").isNotNull()).distinct())
    told = replacements(each, secret)
    held = F.coalesce(F.sum(F.octet_length("raw") + F.octet_length("surrogate") + 128), F.lit(0))
    pairs = each.join(small(told, 1, told.agg(held).first()[0]), "raw")
    entry = F.struct("raw", "surrogate")
    by_doc = pairs.groupBy("_pii_id", "_pii_key").agg(F.map_from_entries(F.collect_set(entry)).alias("_pii_map"))
    by_doc = cut(by_doc.withColumnRenamed("_pii_key", "_pii_text"))
    held = F.coalesce(F.sum(F.aggregate(F.map_entries("_pii_map"), F.lit(192), lambda n, e: n + F.octet_length(e["key"]) + F.octet_length(e["value"]) + 128)), F.lit(0))
    by_doc = small(by_doc, 1, by_doc.agg(held).first()[0])
    joined = touched.join(by_doc, touched[id_column].eqNullSafe(by_doc["_pii_id"]) & (F.col("_pii_key") == F.col("_pii_text")), "left")
    pieces = F.split(text, ANY, -1)
    filled = F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.try_element_at(F.col("_pii_map"), F.get(F.col("_pii_found"), i)), F.lit(""))))
    changed = F.when(F.size("_pii_found") > 0, F.array_join(filled, "")).otherwise(text)
    count = [F.greatest(F.size("_pii_found"), F.lit(0)).cast("long").alias(count_column)] if count_column else []
    replaced = joined.select(*(changed.alias(n) if n == text_column else F.col(n) for n in names), *count)
    return untouched.unionByName(replaced)
