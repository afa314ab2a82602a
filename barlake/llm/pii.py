"""PII surrogates: keyed, type-consistent replacements of detected entities.

Entities (e-mail, phone, payment card, SSN, IPv4, access keys, credentials,
personal names) are found by one regular expression.  Every distinct entity
gets one surrogate drawn from a keyed hash, so all its mentions stay
coreferent across documents and nobody without the key can repeat the draw.
Surrogates keep type and format: digits stay digits in the mention's own
punctuation, cards keep network digit and check digit, e-mails keep their top
level domain, names keep script, gender ending and capitals.

A draw is checked against all other surrogates and all detected entities; the
losers of a collision draw again until all are distinct; from GROW_AFTER
attempts on they grow or take a larger alphabet, so no format runs out.  A
credential that only repeats one mark is a mask and stays.  Only documents with
a mention are shuffled, as mentions; the text of all others passes through.
Main path: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .common import let, query, read_table, written

DEFAULT_KEY = "rotate-me"   # of the synthetic tables only
KEY_SETTING = "spark.barlake.pii.key"
BROADCAST_ENTITIES = 200_000
BROADCAST_BYTES = 64 << 20  # credentials have no length limit
GROW_AFTER = 8              # attempts in the entity's own format; of names, e-mails and credentials also the step of growth

# Honorifics and given names that mark a personal name, with gender.
HONORIFICS = {"m": ("Mr", "Herr", "Señor", "Monsieur", "господин"), "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "госпожа")}
GIVEN_NAMES = {
    "f": ("Alexandra", "Beatrice", "Catherine", "Charlotte", "Elisabeth", "Emma", "Isabella", "Jennifer", "Jessica", "Katharina",
          "Margaret", "Patricia", "Sophie", "Susanne", "Victoria", "Анна", "Екатерина", "Мария", "Наталья", "Ольга"),
    "m": ("Alexander", "Benjamin", "Christopher", "Daniel", "Fernando", "Francisco", "Frederick", "Jonathan", "Matthew", "Michael",
          "Nicholas", "Robert", "Sebastian", "Thomas", "William", "Алексей", "Владимир", "Дмитрий", "Иван", "Сергей"),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ga ge gi ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te va ve vi za".split(),
    "cyrillic": "ба бе би бо ва ве ви га да де ди до за ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се та те".split(),
    "greek": "βα βε δα δε κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα ρα ρε ρι ρο σα σε τα τε".split(),
}
ENDINGS = {"latin": {"f": "na", "m": "ron", "u": "sen"}, "cyrillic": {"f": "на", "m": "рин", "u": "ров"}, "greek": {"f": "να", "m": "ρος", "u": "λης"}}

_CREDENTIAL = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,8}[=:]\s{0,8}\"?"
_MASK = r"([!-/:-@\[-`{-~•●·∙…█■])\1*$"
_NAME = r"\p{Lu}\p{L}+"
_GIVEN = "|".join(n for g in GIVEN_NAMES.values() for n in g)
_HONOR = "|".join(h for g in HONORIFICS.values() for h in g)
PATTERNS = (
    rf"(?<![\p{{L}}\d]){_CREDENTIAL}[^\s\"',;|=:]{{6,}}",
    r"(?<![\p{L}\d])AKIA[A-Z0-9]{16}(?![\p{L}\d])",
    r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9][A-Za-z0-9.-]{0,189}\.[A-Za-z]{2,24}(?![\p{L}\d])",
    r"(?<![\p{L}\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d-])",
    r"(?<![\p{L}\d.+-])\d(?:[ -]?\d){12,18}(?![\p{L}\d])",
    r"(?<![\p{L}\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    rf"(?<!\p{{L}})(?:(?:{_HONOR})\.? {_NAME}(?: {_NAME})?|(?:{_GIVEN}) {_NAME})",
)
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS)
#: Every match holds one of these; texts without skip the full pattern.
HINT = rf"[@\d=:]|{_HONOR}|{_GIVEN}"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _chars(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)


def _luhn_sum(digits: Column, extra: int) -> Column:
    """Luhn sum; ``extra`` is 0 with the check digit present, 1 without."""
    return let(_chars(F.reverse(digits)), lambda cs: F.aggregate(
        F.transform(cs, lambda c, i: let(c.cast("int") * F.when((i + extra) % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x))),
        F.lit(0), lambda a, x: a + x))


def kind_of(m: Column) -> Column:
    """Type of a match; NULL if its value is not valid (octets, check digit, mask)."""
    n = F.length(_digits(m))
    octets = F.aggregate(F.split(m, r"\."), F.lit(0), lambda a, o: F.greatest(a, o.try_cast("int")))
    return (F.when(F.regexp_like(m, F.lit("^" + _CREDENTIAL)), F.when(~F.regexp_like(m, F.lit("^" + _CREDENTIAL + _MASK)), F.lit("credential")))
            .when(F.regexp_like(m, F.lit("^AKIA[A-Z0-9]{16}$")), F.lit("access_key"))
            .when(F.contains(m, F.lit("@")), F.lit("email"))
            .when(F.regexp_like(m, F.lit(r"^\d+(\.\d+){3}$")), F.when(octets <= 255, F.lit("ip")))
            .when(F.regexp_like(m, F.lit(r"^\d{3}-\d{2}-\d{4}$")), F.lit("ssn"))
            .when(n >= 13, F.when(_luhn_sum(_digits(m), 0) % 10 == 0, F.lit("card")))
            .when(n > 0, F.lit("phone")).otherwise(F.lit("name")))


def _bare_name(m: Column) -> Column:
    return F.regexp_replace(m, rf"^(?:{_HONOR})\.? ", "")


def _gender(m: Column) -> Column:
    g = lambda x: F.regexp_like(m, F.lit(rf"^(?:{'|'.join(HONORIFICS[x] + GIVEN_NAMES[x])})[. ]"))
    return F.when(g("f"), F.lit("f")).when(g("m"), F.lit("m")).otherwise(F.lit("u"))


def entities_of(m: Column) -> Column:
    """Array of (kind, canon) of one match: one for each part of a name, one for any other type."""
    ent = lambda k, c: F.struct(k.alias("kind"), c.alias("canon"))
    one = lambda k, c: F.array(ent(F.lit(k), c))
    kind = kind_of(m)

    def name_parts(p: Column) -> Column:
        return F.transform(p, lambda x, i: ent(F.when(i < F.size(p) - 1, F.concat(F.lit("given_"), _gender(m))).otherwise(F.lit("surname")), F.lower(x)))

    return let(kind, lambda k: F.when(k == "credential", one("credential", F.regexp_replace(m, "^" + _CREDENTIAL, "")))
               .when(k == "email", one("email", F.lower(m)))
               .when(k == "phone", one("phone", F.right(_digits(m), F.lit(10))))
               .when(k == "card", one("card", _digits(m)))
               .when(k == "ssn", one("ssn", _digits(m)))
               .when(k == "name", let(F.split(_bare_name(m), " "), name_parts))
               .when(k.isNotNull(), F.array(ent(k, m)))
               .otherwise(F.array().cast("array<struct<kind:string,canon:string>>")))


def draw(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Surrogate number ``attempt`` of an entity; a keyed hash seeds every character."""
    seed_of = lambda k, c, a: F.sha2(F.concat_ws("|", F.lit(key), k, c, a.cast("string")), 256)

    def with_seed(seed: Column) -> Column:
        at = lambda i, n, s=seed: F.pmod(F.xxhash64(s, i), F.lit(n)).cast("int")
        pick = lambda i, chars, s=seed: F.substring(F.lit(chars), at(i, len(chars), s) + 1, F.lit(1))
        low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

        def like(c: Column, s: Column = seed) -> Column:
            return F.concat_ws("", F.transform(_chars(c), lambda x, i: F.when(F.regexp_like(x, F.lit("[0-9]")), pick(i, num, s))
                                               .when(F.regexp_like(x, F.lit("[a-z]")), pick(i, low, s))
                                               .when(F.regexp_like(x, F.lit("[A-Z]")), pick(i, up, s)).otherwise(x)))

        def more(chars: str) -> Column:
            """Further characters, one for every GROW_AFTER attempts."""
            return F.concat_ws("", F.transform(F.sequence(F.lit(0), F.floor(attempt / GROW_AFTER).cast("int")), lambda i: F.when(i > 0, pick(i + 1000, chars)).otherwise(F.lit(""))))

        def secret(c: Column) -> Column:
            """Every character drawn anew in its class; - _ . stay where letters or digits surround them."""
            shaped = F.regexp_like(c, F.lit(r"[\p{L}\p{N}]"))
            is_ = lambda x, p: F.regexp_like(x, F.lit(p))
            return F.concat_ws("", F.transform(_chars(c), lambda x, i: F.when(is_(x, r"\p{N}"), pick(i, num)).when(is_(x, r"\p{Lu}"), pick(i, up))
                                               .when(is_(x, r"[\p{L}\p{M}]"), pick(i, low)).when(shaped & is_(x, "[-_.]"), x).otherwise(pick(i, "!#$%&*+-./?@^_~"))))

        hex_like = F.concat_ws("", F.transform(_chars(canon), lambda x, i: pick(i, "0123456789abcdef")))
        longer = more(low)
        grown = attempt >= GROW_AFTER
        mixed = F.concat_ws("", F.transform(_chars(canon), lambda x, i: pick(i, num + up)))     # as long as the digits it replaces
        domain = F.regexp_extract(canon, "@(.*)$", 1)
        tld = F.regexp_extract(domain, r"\.([^.]*)$", 1)
        host = F.regexp_extract(domain, r"^(.*)\.[^.]*$", 1)
        email = F.concat(like(F.regexp_extract(canon, "^([^@]*)@", 1)), longer, F.lit("@"),
                         let(seed_of(F.lit("domain"), domain, F.lit(0)), lambda s: like(host, s)), F.lit("."), tld)
        ip = F.concat_ws(".", *[F.when(grown, at(F.lit(i), 1000)).otherwise(F.lit(1) + at(F.lit(i), 223) if i == 0 else at(F.lit(i), 256)).cast("string") for i in range(4)])
        head = F.concat(F.substring(canon, 1, 1), F.substring(like(canon), F.lit(2), F.length(canon) - 2))
        card = let(head, lambda h: F.concat(h, ((10 - _luhn_sum(h, 1) % 10) % 10).cast("string")))
        script = (F.when(F.regexp_like(canon, F.lit(r"\p{IsCyrillic}")), F.lit("cyrillic"))
                  .when(F.regexp_like(canon, F.lit(r"\p{IsGreek}")), F.lit("greek")).otherwise(F.lit("latin")))

        def name_in(sc: str) -> Column:
            syl = F.array(*[F.lit(x) for x in SYLLABLES[sc]])
            body = F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(1) + F.floor(attempt / GROW_AFTER).cast("int")), lambda i: F.get(syl, at(i, len(SYLLABLES[sc])))))
            end = ENDINGS[sc]
            return F.concat(body, F.when(kind == "given_f", F.lit(end["f"])).when(kind == "given_m", F.lit(end["m"])).otherwise(F.lit(end["u"])))

        name = F.when(script == "cyrillic", name_in("cyrillic")).when(script == "greek", name_in("greek")).otherwise(name_in("latin"))
        return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind.isin("phone", "card", "ssn") & grown, mixed).when(kind == "card", card)
                .when(kind == "access_key", F.concat(F.lit("AKIA"), F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: pick(i, up + "234567")))))
                .when(kind.startswith("given_") | (kind == "surname"), name)
                .when(F.regexp_like(canon, F.lit("^[0-9a-f]*[a-f][0-9a-f]*$")), F.concat(hex_like, more("0123456789abcdef")))
                .when(kind == "credential", F.concat(secret(canon), longer)).otherwise(like(canon)))

    return let(seed_of(kind, canon, attempt), with_seed)


def _space(kind: Column) -> Column:
    return F.when(kind.startswith("given_") | (kind == "surname"), F.lit("name")).otherwise(kind)


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) of distinct ``entities(kind, canon)``; surrogates are distinct and no real entity.

    An entity that loses a collision (to one settled earlier, else to the
    smaller one) draws again; each round is written before the next.  Where a
    format has too few values, surrogates get longer or take letters for digits.
    """
    t = entities.distinct().withColumn("attempt", F.lit(0))
    real = None
    while True:                                          # ends: drawn formats grow past the number of entities
        t = cut_lineage(t.withColumn("space", _space(F.col("kind"))).withColumn("surrogate", draw(F.col("kind"), F.col("canon"), F.col("attempt"), key)))
        if real is None:
            real = t.select("space", F.col("canon").alias("surrogate")).distinct()
        mine = F.struct("attempt", "kind", "canon")
        owner = t.groupBy("space", "surrogate").agg(F.min(mine).alias("owner"), F.count("*").alias("n")).where("n > 1")
        lost = (t.join(owner, ["space", "surrogate"]).where(mine != F.col("owner")).select("kind", "canon")
                .unionByName(t.join(real, ["space", "surrogate"], "left_semi").select("kind", "canon")).distinct())
        lost = cut_lineage(lost.withColumn("again", F.lit(1)))
        if lost.isEmpty():
            return t.select("kind", "canon", "surrogate")
        t = t.join(lost, ["kind", "canon"], "left").select("kind", "canon", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"))


def render(m: Column, surrogates: Column) -> Column:
    """A mention written with the surrogates of its entities, in the mention's own format."""
    s = F.get(surrogates, F.lit(0))

    def digits_into(shape: Column, digits: Column) -> Column:
        """Digits replace those of the mention from the right; surplus leading digits (country code) stay."""
        cs = _chars(shape)
        extra = F.length(_digits(shape)) - F.length(digits)
        nth = lambda i: F.length(_digits(F.substring(shape, F.lit(1), i + 1))) - extra
        return F.concat_ws("", F.transform(cs, lambda c, i: F.when(F.regexp_like(c, F.lit("[0-9]")) & (nth(i) > 0), F.substring(digits, nth(i), F.lit(1))).otherwise(c)))

    def capitals(like: Column, x: Column) -> Column:
        return F.when((like == F.upper(like)) & (like != F.lower(like)) & (F.length(like) > 1), F.upper(x)).when(
            F.substring(like, 1, 1) == F.upper(F.substring(like, 1, 1)), F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))).otherwise(x)

    bare = _bare_name(m)
    name = F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(bare)),
                    F.concat_ws(" ", F.zip_with(F.split(bare, " "), surrogates, capitals)))
    kind = kind_of(m)
    return let(kind, lambda k: F.when(k.isNull() | (F.size(surrogates) == 0), m)
               .when(k.isin("phone", "card", "ssn"), digits_into(m, s))
               .when(k == "credential", F.concat(F.regexp_extract(m, "^" + _CREDENTIAL, 0), s))
               .when(k == "email", F.when(m == F.upper(m), F.upper(s)).otherwise(s))
               .when(k == "name", name).otherwise(s))


def session_key(spark: SparkSession) -> str:
    """The key that the session names in ``spark.barlake.pii.key``; unset, that of the synthetic tables."""
    return spark.conf.get(KEY_SETTING, DEFAULT_KEY)


def pseudonymize(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every detected entity of the text replaced; columns and rows stay.

    * NULL text stays NULL, empty text empty; other columns are never read and may have any name.
    * Repeated rows are replaced alike; an empty table gives no rows; NULLs elsewhere do not matter.
    * Texts of any length are scanned whole.  A mention that fails its check
      (card digit, octets over 255) is no entity and stays; so does a masked credential (``********``).
    * ``count_col`` adds the number of replaced mentions; named like a column of ``docs`` (in any case) it is an error.
    * One entity may be mentioned by most documents: mentions meet the table of
      entities by broadcast while it is small, else by a join that splits hot keys.
    """
    names = docs.columns
    if count_col and count_col.lower() in [c.lower() for c in names]:
        raise ValueError(f"docs has a column {count_col}")
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    text = F.col(f"`{text_col}`")
    hint = F.regexp_like(text, F.lit(HINT))
    found = F.when(hint, F.regexp_extract_all(text, F.lit(PATTERN), 0))
    marked = docs.select(row.alias("_row"), text.alias("_t"), found.alias("_m"))
    has = F.coalesce(F.size("_m") > 0, F.lit(False))
    # texts with mentions, written once with a row number
    hit = written(marked.where(has).select("_row", "_m", F.split("_t", PATTERN, -1).alias("_parts"),
                                           F.monotonically_increasing_id().alias("_rid")), "pii-mentions")
    each = hit.select("_rid", F.posexplode("_m").alias("_i", "m")).select(
        "_rid", "_i", F.posexplode(entities_of(F.col("m"))).alias("_j", "e")).select("_rid", "_i", "_j", "e.kind", "e.canon")
    table = surrogate_table(each.select("kind", "canon"), key)
    named = each.join(broadcast_if_small(table, BROADCAST_ENTITIES, BROADCAST_BYTES), ["kind", "canon"])
    by_row = named.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("_i", "_j", "surrogate"))).alias("_s"))

    def of_match(i: Column) -> Column:
        return F.transform(F.filter(F.col("_s"), lambda x: x["_i"] == i), lambda x: x["surrogate"])

    new = F.transform("_m", lambda m, i: let(F.coalesce(of_match(i), F.array().cast("array<string>")), lambda s: render(m, s)))
    # a text has one part more than mentions
    text_out = let(new, lambda r: F.concat_ws("", F.transform(F.col("_parts"), lambda p, i: F.concat(p, F.coalesce(F.get(r, i), F.lit(""))))))
    n_out = F.size(F.array_distinct(F.transform(F.coalesce("_s", F.array().cast("array<struct<_i:int,_j:int,surrogate:string>>")), lambda x: x["_i"]))).cast("long")

    def columns(t: Column, n: Column) -> list[Column]:
        out = [t.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in names]
        return out + ([n.alias(count_col)] if count_col else [])

    # hot mentions: rows meet their replacements by row number, never by entity
    done = hit.join(by_row, "_rid", "left").select(*columns(text_out, n_out))
    clean = marked.where(~has).select(*columns(F.col("_t"), F.lit(0).cast("long")))
    return clean.unionByName(done)


@query("op9_pii_surrogates")
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, session_key(spark), count_col="n_replaced")
