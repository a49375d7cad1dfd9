"""Text functions. Native expressions where Spark has what they need; Unicode decomposition goes through Arrow."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ligatures and apostrophes that folding replaces.
LIGATURES = {"œ": "oe", "Œ": "oe", "æ": "ae", "Æ": "ae"}
APOSTROPHES = ["'", "’", "ʼ"]

# Vocabularies of the facets.
SCHOOLS = ["abjuration", "divination", "enchantement", "evocation", "illusion", "invocation", "necromancie", "transmutation", "universel"]
SAVES = ["volonte", "vigueur", "reflexes"]
ACTIONS = ["action simple", "action immediate", "action rapide", "action complexe"]
TIME_UNITS = ["round", "minute", "heure", "semaine"]
COMPONENTS = ["FD", "DF", "V", "G", "M", "F", "S"]


def _plain(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


# Latin letters that decompose into one letter and marks, with that letter, by rule.
_MARKED = [chr(i) for block in ((0xC0, 0x250), (0x1E00, 0x1F00)) for i in range(*block) if len(_plain(chr(i))) == 1 and _plain(chr(i)) != chr(i)]
ACCENTED, PLAIN = "".join(_MARKED), "".join(map(_plain, _MARKED))


def without_marks(x: Column) -> Column:
    """Latin letters without their marks, and without combining marks of their own; native."""
    return F.translate(F.regexp_replace(x, r"\p{Mn}+", ""), ACCENTED, PLAIN)


def _plain_lower(x: Column) -> Column:
    """What all keys start from; written alike in each, so that one text is folded once for several keys."""
    return F.lower(without_marks(x))


def fold_latin(x: Column) -> Column:
    """Lower case without marks and ligatures of Latin letters; native."""
    x = _plain_lower(x)
    for a, b in LIGATURES.items():
        if a == a.lower():
            x = F.replace(x, F.lit(a), F.lit(b.lower()))
    return x


def normal(x: Column) -> Column:
    """Lower case without marks, trimmed: what rules are compared in. Ligatures and apostrophes stay."""
    return F.trim(_plain_lower(x))


def let(value: Column, body) -> Column:
    """body(value), where value is worked out once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spaces(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def search_key(x: Column) -> Column:
    """What searches compare Latin text in: folded, apostrophes as spaces, spaces collapsed; native."""
    x = fold_latin(x)
    for a in APOSTROPHES:
        x = F.replace(x, F.lit(a), F.lit(" "))
    return spaces(x)


def label_key(x: Column) -> Column:
    """Key of a label: straight apostrophes, no marks, spaces collapsed, without colons at the end."""
    straight = F.regexp_replace(F.replace(_plain_lower(x), F.lit("\u00a0"), F.lit(" ")), "[’‘ʼ]", "'")
    return F.trim(F.regexp_replace(spaces(straight), ":+$", ""))


def citation_key(x: Column) -> Column:
    """Lenient form of a quotation: no marks, straight quotes, spaces collapsed."""
    flat = F.replace(_plain_lower(x), F.lit("\u00a0"), F.lit(" "))
    return spaces(F.regexp_replace(F.regexp_replace(flat, "[’‘]", "'"), "[“”]", '"'))


@F.pandas_udf(T.StringType())
def fold_nfkd(x: pd.Series) -> pd.Series:
    """Lower case, ligatures replaced, apostrophes to spaces, decomposed without marks, spaces collapsed; any script."""

    def one(s: str | None) -> str | None:
        if s is None:
            return None
        for a, b in LIGATURES.items():
            s = s.replace(a, b)
        for a in APOSTROPHES:
            s = s.replace(a, " ")
        s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
        return " ".join(s.lower().split())

    return x.map(one, na_action="ignore")


@F.pandas_udf(T.StringType())
def fold_nfc(x: pd.Series) -> pd.Series:
    """Composed form with straight apostrophes: what quoted evidence is compared in."""
    return x.map(lambda s: unicodedata.normalize("NFC", s).replace("’", "'"), na_action="ignore")


def slug(x: Column, joiner: str = "-") -> Column:
    """Folded Latin text, other characters to single joiners, none at the ends."""
    return F.regexp_replace(F.regexp_replace(fold_latin(x), "[^a-z0-9]+", joiner), f"^{joiner}|{joiner}$", "")


def slug_or(x: Column, default: str) -> Column:
    return F.coalesce(F.nullif(slug(x), F.lit("")), F.lit(default))


def singular(x: Column) -> Column:
    """French plural s off words of more than four letters, unless doubled."""
    return F.when((F.char_length(x) > 4) & F.endswith(x, F.lit("s")) & ~F.endswith(x, F.lit("ss")), F.substr(x, F.lit(1), F.char_length(x) - 1)).otherwise(x)


def bag_key(x: Column, stop_words: list[str]) -> Column:
    """Words without stop words, in the singular, sorted and joined; the slug where nothing is left."""
    words = F.filter(F.split(slug(x, "_"), "_"), lambda w: ~w.isin(*stop_words) & (w != ""))
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.transform(words, singular)), "_"), F.lit("")), slug(x, "_"))


def split_top_level(x: Column) -> Column:
    """Parts between commas and semicolons that no parenthesis encloses, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(x, r"[,;]\s*(?![^()]*\))"), lambda p: F.trim(p)), lambda p: p != "")


def split_alternatives(x: Column) -> Column:
    return F.transform(F.split(x, r"(?i)\s+ou\s+"), lambda p: F.trim(p))


def parse_levels(x: Column) -> Column:
    """``Bard 2, Pal 1`` to a map of name to level; of a repeated name the first counts."""
    names = F.transform(F.regexp_extract_all(x, F.lit(r"([A-Za-z/]+) (\d)"), F.lit(1)), lambda n: F.lower(n))
    levels = F.transform(F.regexp_extract_all(x, F.lit(r"([A-Za-z/]+) (\d)"), F.lit(2)), lambda n: n.cast("int"))
    first = F.filter(F.transform(names, lambda n, i: F.struct(n.alias("k"), F.element_at(levels, i + 1).alias("v"), (F.array_position(names, n) == i + 1).alias("first"))), lambda p: p["first"])
    return F.map_from_arrays(F.transform(first, lambda p: p["k"]), F.transform(first, lambda p: p["v"]))


def level_map(x: Column) -> Column:
    """struct (levels, rejects) of ``Bard 2, Ens/Mag 3 (x)``: a map of name to level, of a repeated name the first, and the parts
    that aren't pairs. Pairs that only blanks part (``magus 1 Ens/Mag 1``) are told apart."""
    chunks = F.filter(F.transform(F.split(x, ","), lambda c: F.trim(F.regexp_replace(F.trim(c), ";+$", ""))), lambda c: c != "")
    whole = r"^(.+?)\s+(\d+)(?:\s*\(.*\))?$"
    glued = r"([^\d,()]+?)\s+(\d+)"
    pair = lambda k, v: F.struct(F.trim(k).alias("k"), v.cast("int").alias("v"))

    def pairs(c: Column) -> Column:
        several = F.zip_with(F.regexp_extract_all(c, F.lit(glued), F.lit(1)), F.regexp_extract_all(c, F.lit(glued), F.lit(2)), pair)
        one = F.regexp_extract(c, whole, 1)
        return F.when(one.rlike("[0-9]") & (F.size(several) > 1), several).otherwise(F.array(pair(one, F.regexp_extract(c, whole, 2))))

    found = F.flatten(F.transform(F.filter(chunks, lambda c: c.rlike(whole)), pairs))
    names = F.transform(found, lambda p: p["k"])
    levels = F.map_from_entries(F.filter(found, lambda p, i: F.array_position(names, p["k"]) == i + 1))
    empty = F.struct(F.map_from_entries(F.array().cast("array<struct<k:string,v:int>>")).alias("levels"), F.array().cast("array<string>").alias("rejects"))
    return F.coalesce(F.when(x.isNotNull(), F.struct(levels.alias("levels"), F.filter(chunks, lambda c: ~c.rlike(whole)).alias("rejects"))), empty)


def family(x: Column, prefixes: dict[str, str], default: str) -> Column:
    """The family of the first prefix that the folded text starts with."""
    folded, out = fold_latin(F.trim(x)), None
    for prefix, name in prefixes.items():
        out = F.when(F.startswith(folded, F.lit(prefix)), name) if out is None else out.when(F.startswith(folded, F.lit(prefix)), name)
    return F.when(x.isNotNull(), out.otherwise(default))


def tri_state(x: Column, yes: str = "oui", no: str = "non") -> Column:
    """true, false, or null where the text says neither or both."""
    folded = fold_latin(F.trim(x))
    says = lambda w: F.contains(folded, F.lit(w))
    return F.when(says(yes) & ~says(no), True).when(says(no) & ~says(yes), False)


def signed_integer(x: Column) -> Column:
    return F.try_to_number(F.regexp_replace(F.regexp_replace(F.trim(x), "[–−]", "-"), r"^\+", ""), F.lit("S999999")).cast("int")


def metres(x: Column) -> Column:
    """``4,5 m`` to 4.5; null where no number stands before an m."""
    return F.replace(F.nullif(F.regexp_extract(x, r"(\d+(?:,\d+)?)\s*m", 1), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def url_key(x: Column) -> Column:
    return F.lower(F.trim(F.url_decode(x)))


def runs_of(levels: Column) -> Column:
    """Sorted distinct integers as ``0-2,5``: runs of three or more become ranges."""
    ordered = F.array_sort(F.array_distinct(levels))
    keyed = F.transform(ordered, lambda v, i: F.struct((v - i).alias("g"), v.alias("v")))
    groups = F.transform(F.array_distinct(F.transform(keyed, lambda k: k["g"])), lambda g: F.transform(F.filter(keyed, lambda k: k["g"] == g), lambda k: k["v"]))
    text = lambda v: v.cast("string")
    return F.array_join(F.transform(groups, lambda r: F.when(F.size(r) >= 3, F.concat(text(F.array_min(r)), F.lit("-"), text(F.array_max(r)))).otherwise(F.array_join(F.transform(r, text), ","))), ",")


def head(x: Column) -> Column:
    """The folded text before a parenthesis."""
    return search_key(F.split(x, r"\(")[0])


def school(x: Column, known: list[str] = SCHOOLS) -> Column:
    """Canonical school, null where there is none; an unknown one fails the job."""
    h = head(x)
    out = F.when(F.startswith(h, F.lit("universel")), "universel").when(h.isin(*known), h)
    return F.when(F.coalesce(h, F.lit("")) == "", F.lit(None)).otherwise(F.coalesce(out, F.raise_error(F.concat(F.lit("unknown school: "), x)).cast("string")))


def sampling_school(x: Column) -> Column:
    """Group name of a school for samples: accents stay, brackets go, one spelling of the universal one."""
    h = F.trim(F.translate(F.split(x, r"\(")[0], "[]", "  "))
    base = F.concat(F.upper(F.substring(h, 1, 1)), F.lower(F.substr(h, F.lit(2))))
    return F.when(F.startswith(base, F.lit("Univers")), "Universelle").otherwise(F.nullif(base, F.lit("")))


def first_contained(x: Column, words: list[str], default: Column | str) -> Column:
    """The first of the words that the folded text holds, spaces as underscores."""
    key, out = search_key(x), None
    for w in words:
        holds, name = F.contains(key, F.lit(w)), F.lit(w.replace(" ", "_"))
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return F.when(F.coalesce(key, F.lit("")) != "", out.otherwise(default))


def save_family(x: Column) -> Column:
    key = search_key(x)
    return F.when(F.startswith(key, F.lit("aucun")) | (key == "non"), "aucun").otherwise(first_contained(x, SAVES, "special"))


def casting_family(x: Column) -> Column:
    return first_contained(x, [*ACTIONS, *TIME_UNITS], "special")


def components(x: Column) -> Column:
    """Component sigils outside parentheses, both spellings of the divine focus as one, sorted."""
    plain = F.upper(without_marks(F.regexp_replace(x, r"\([^)]*\)", " ")))
    found = F.regexp_extract_all(plain, F.lit(rf"\b({'|'.join(COMPONENTS)})\b"), F.lit(1))
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(found, lambda c: F.when(c == "DF", "FD").otherwise(c)))), F.array().cast("array<string>"))


def split_school(x: Column) -> Column:
    """``School [a, b]`` as struct (school, descriptors)."""
    groups = F.regexp_extract_all(x, F.lit(r"\[([^\]]*)\]"), F.lit(1))
    parts = F.filter(F.transform(F.flatten(F.transform(groups, lambda g: F.split(g, ","))), lambda p: F.trim(p)), lambda p: p != "")
    name = F.trim(F.regexp_replace(F.trim(F.regexp_replace(x, r"\[[^\]]*\]", "")), ";+$", ""))
    return F.struct(F.nullif(name, F.lit("")).alias("school"), F.coalesce(parts, F.array().cast("array<string>")).alias("descriptors"))


def feat_name(x: Column) -> Column:
    """A name without the stars at its end."""
    return F.trim(F.regexp_replace(F.trim(x), r"\*+$", ""))


def with_additions(conditions: Column, additions: Column, empty: list[str] = ("", "-", "—", "–", "nan", "#error!")) -> Column:
    """A condition text with the added ones behind it; a text that says none is left out."""
    base = F.filter(F.array(F.trim(conditions)), lambda c: ~F.lower(c).isin(*empty))
    return F.when(F.coalesce(F.size(additions), F.lit(0)) > 0, F.array_join(F.concat(base, additions), ", ")).otherwise(conditions)


def contained(x: Column, keywords: list[str]) -> Column:
    """The keywords that the normalised text holds, in their order."""
    key = normal(x)
    return F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(key, normal(k)))


def categories(x: Column, keywords: dict[str, list[str]]) -> Column:
    """Names of the keyword lists of which the text holds one, sorted."""
    return F.array_sort(F.array_compact(F.array(*[F.when(F.size(contained(x, words)) > 0, F.lit(name)) for name, words in keywords.items()])))


def graded(x: Column, strong: list[str], excluding: list[str], weak: list[str]) -> Column:
    """struct (holds, unsure, matched): strong keywords decide, then excluding ones, weak ones leave it open."""
    a, b, c = contained(x, strong), contained(x, excluding), contained(x, weak)
    nothing = F.array().cast("array<string>")
    weakly = (F.size(a) == 0) & (F.size(b) == 0) & (F.size(c) > 0)
    return F.struct((F.size(a) > 0).alias("holds"), weakly.alias("unsure"), F.when(F.size(a) > 0, a).when(weakly, c).otherwise(nothing).alias("matched"))


def affinity(x: Column, pattern: str, most_words: int = 4) -> Column:
    """struct (phrase, simple) of the pattern's first group; null where it isn't found. Simple phrases are short, without
    commas and comparisons."""
    phrase = F.trim(F.regexp_extract(x, pattern, 1))
    simple = (F.size(F.split(phrase, r"\s+")) <= most_words) & ~F.contains(phrase, F.lit(",")) & ~F.contains(F.lower(phrase), F.lit(" comme "))
    return F.when(phrase != "", F.struct(phrase.alias("phrase"), simple.alias("simple")))


def ordered_rules(x: Column, exact: dict[str, list[str]], prefixes: dict[str, list[str]], default: str) -> Column:
    """The kind of the first rule that holds: exact texts by kind, then beginnings by kind."""
    key, out = normal(x), None
    for kind, words in exact.items():
        out = F.when(key.isin(*words), kind) if out is None else out.when(key.isin(*words), kind)
    for kind, words in prefixes.items():
        starts = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.startswith(key, w))
        out = F.when(starts, kind) if out is None else out.when(starts, kind)
    return F.lit(default) if out is None else out.otherwise(default)


def absolute_url(x: Column, site: str, folder: str) -> Column:
    """A relative address on a site: as it is with a scheme, with one before ``//``, below the site or the folder."""
    h = F.trim(x)
    return F.when(h.rlike("^https?://"), h).when(F.startswith(h, F.lit("//")), F.concat(F.lit("https:"), h)).when(F.startswith(h, F.lit("/")), F.concat(F.lit(site), h)).otherwise(F.concat(F.lit(folder), h))


def percent(n: Column, total: Column, digits: int = 1) -> Column:
    return F.when(total == 0, F.lit("0 %")).otherwise(F.format_string(f"%.{digits}f %%", F.lit(100.0) * n / total))


def share_label(n: Column, total: Column) -> Column:
    """Whole percent; what is above nothing but below one percent says so."""
    whole = F.round(F.lit(100.0) * n / total).cast("int")
    return F.when((n > 0) & (n * 100 < total), "< 1 %").otherwise(F.concat(whole.cast("string"), F.lit(" %")))


def file_name(name: Column, day: Column, default: str, ending: str = "json") -> Column:
    return F.concat(slug_or(name, default), F.lit("-"), F.date_format(day, "yyyy-MM-dd"), F.lit(f".{ending}"))


def json_object(x: Column) -> Column:
    """From the first brace to the last, fences or words around it dropped; null where that isn't an object."""
    inner = F.nullif(F.regexp_extract(x, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.when(F.json_object_keys(inner).isNotNull(), inner)


def answer_labels(x: Column, most_chars: int = 60) -> Column:
    """One label for each line of an answer, in order, each once: bullets stripped, lines of several words or too long
    dropped, colons and full stops at the end stripped."""
    lines = F.transform(F.split(x, r"\r?\n"), lambda v: F.regexp_replace(F.trim(v), r"^[-*•\t ]+|[-*•\t ]+$", ""))
    kept = F.filter(lines, lambda v: (v != "") & ~F.contains(v, F.lit(" ")) & (F.char_length(v) <= most_chars))
    return F.array_distinct(F.filter(F.transform(kept, lambda v: F.regexp_replace(v, r"[:.]+$", "")), lambda v: v != ""))


def readable(x: Column) -> Column:
    return F.translate(x, "_", " ")


def labelled(x: Column, labels: dict[str, str]) -> Column:
    """The label of a code, the readable code where there is none."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in labels.items() for v in kv]), x), readable(x))


def in_order(chosen: Column, vocabulary: list[str]) -> Column:
    """The known values among the chosen, each once, in the vocabulary's order."""
    return F.filter(F.array(*[F.lit(v) for v in vocabulary]), lambda v: F.array_contains(chosen, v))


def longest_only(found: Column) -> Column:
    """Keywords that no longer found keyword holds."""
    return F.filter(found, lambda k: ~F.exists(found, lambda o: (F.char_length(o) > F.char_length(k)) & F.contains(o, k)))
