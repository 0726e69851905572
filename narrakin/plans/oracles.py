"""DuckDB SQL with the same results as the queries, for checking them."""

from __future__ import annotations

from narrakin.functions import lexicons as L
from narrakin.functions.similarity import COUNTED
from narrakin.functions.text import _bank_word_runs
from narrakin.operators.topk import lsh_tables
from narrakin.options import MatchOptions
from narrakin.plans import fixtures as X

MATCHES = 10
FLOOR = 0.3


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _pick(pool: list[str], index: str) -> str:
    return f"({_list(pool)})[CAST({index} AS BIGINT) + 1]"


def _name(k: str, parts: str = "name letters trade legal city") -> str:
    have = {
        "name": _pick(X.NAMES, f"{k} % 20"),
        "letters": " || ".join(f"chr(CAST(65 + ({k} // {d}) % 26 AS INTEGER))" for d in (1, 26, 676)),
        "trade": _pick(X.TRADES, f"({k} // 20) % 12"),
        "legal": _pick(X.LEGAL, f"{k} % 5"),
        "city": _pick(X.CITIES, f"({k} // 7) % 16"),
    }
    chosen = ", ".join(f"({have[p]})" for p in parts.split())
    return f"trim(regexp_replace(concat_ws(' ', {chosen}), ' +', ' ', 'g'))"


def _sub(x: str, pattern: str, new: str = " ") -> str:
    return f"regexp_replace({x}, '{pattern}', '{new}', 'g')"


def _squeeze(x: str) -> str:
    return f"trim({_sub(x, r'\s+')})"


def _any(phrases: list[str]) -> str:
    return "|".join(L.longest_first(phrases))


NOISE = rf"\b({_any(L.NOISE_PHRASES)})\b[/\s]*"


def _fold(x: str) -> str:
    return f"lower(trim(coalesce({x}, '')))"


def _noise(x: str) -> str:
    return _sub(x, NOISE)


def _codes(x: str) -> str:
    x = _sub(x, r"\b[a-z0-9]*\*{3,}[a-z0-9]*\b")
    x = _sub(x, r"\b[a-z0-9]{10,}\b")
    x = _sub(x, r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b")
    return _sub(x, r"[/\-_]{2,}")


def _banks(x: str) -> str:
    runs = "|".join(r.replace(" ", "  ") for r in _bank_word_runs())
    doubled = f"(' ' || replace({_squeeze(x)}, ' ', '  ') || ' ')"
    return _squeeze(_sub(doubled, f" ({runs}) ", ""))


def _punct(x: str) -> str:
    return _squeeze(_sub(x, r"[^\w\s]"))


def _short(x: str) -> str:
    kept = f"lambda w: length(w) > 2 OR list_contains({_list(L.COMPANY_SUFFIXES)}, w)"
    return f"array_to_string(list_filter(string_split({x}, ' '), {kept}), ' ')"


def _clean(x: str) -> str:
    return _short(_punct(_banks(_codes(_noise(_fold(x))))))


def _detected(x: str) -> str:
    x = _squeeze(_sub(_sub(f"trim({x})", rf"\b({_any(L.BANKS)})\b", ""), NOISE, ""))
    return f"CASE WHEN length({x}) < 3 THEN '' ELSE {x} END"


def _normalize(x: str) -> str:
    x = _sub(_fold(x), rf"\b({'|'.join(L.LEGAL_WORDS)})\b", "")
    x = _sub(x, r"\band\b|\b&\b", "")
    return _punct(_sub(x, rf"\b({'|'.join(L.ARTICLES)})\b", ""))


def _loc(x: str) -> str:
    x = _sub(_fold(x), rf"^({'|'.join(L.CHANNEL_PREFIXES)})[\s/]", "")
    keep = (r"lambda p: length(p) > 2 AND length(p) < 50 AND NOT regexp_full_match(p, '[0-9]+') "
            r"AND NOT regexp_full_match(p, '[a-z0-9]{10,}')")
    return f"array_to_string(list_filter(string_split_regex({x}, '[/\\-_\\s]+'), {keep}), ' ')"


def _words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def _first_of_each(x: str) -> str:
    return f"list_filter({x}, lambda x, i: list_position({x}, x) = i)"


def _suffixed(x: str) -> str:
    hit = f"lambda w: length(w) < 25 AND regexp_full_match(w, '.{{3,}}({'|'.join(L.LOCATION_SUFFIXES)})')"
    return f"list_filter({_words(x)}, {hit})"


def _cities(x: str) -> str:
    return f"list_filter({_list(sorted(L.MAJOR_CITIES))}, lambda c: contains({x}, c))"


def _masks(a: str, b: str) -> str:
    """For each letter of b, the positions in a that hold it, as bits."""
    return (f"list_transform(range(1, length({b}) + 1), lambda j: CAST(coalesce(list_sum(list_transform("
            f"range(1, length({a}) + 1), lambda i: CASE WHEN substr({a}, i, 1) = substr({b}, j, 1) "
            f"THEN 1::BIGINT << (i - 1)::BIGINT ELSE 0::BIGINT END)), 0) AS BIGINT))")


def _lcs(length: str, masks: str) -> str:
    full = f"((1::BIGINT << ({length})::BIGINT) - 1)"
    return (f"(({length}) - bit_count(list_reduce({masks}, lambda v, x: ((v + (v & x)) | (v & ~x)) & {full}, "
            f"{full})))")


def _ratio(a: str, b: str, masks: str) -> str:
    return (f"CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE "
            f"ELSE 200.0::DOUBLE * {_lcs(f'length({a})', masks)} / (length({a}) + length({b})) END")


def _windows(s: str, l: str, masks: str) -> str:
    first, last = "greatest(i, 1)", f"least(i + length({s}) - 1, length({l}))"
    return (f"list_max(list_transform(range(2 - length({s}), length({l}) + 1), lambda i: 200.0::DOUBLE * "
            f"{_lcs(f'length({s})', f'list_slice({masks}, {first}, {last})')} "
            f"/ (length({s}) + {last} - {first} + 1)))")


NARRATION_BODY = f"""CASE o_orderkey % 8
  WHEN 1 THEN {_name('o_custkey', 'name letters trade city')}
  WHEN 2 THEN {_name('o_custkey', 'name letters city')}
  WHEN 3 THEN {_name('o_custkey')} || ' HDFC BANK'
  WHEN 4 THEN {_name('o_custkey')} || ' STATE BANK OF INDIA'
  WHEN 5 THEN array_to_string(list_reverse(string_split({_name('o_custkey')}, ' ')), ' ')
  WHEN 6 THEN {_name('o_custkey')} || ' A****885 12-05-2024'
  WHEN 7 THEN upper(substring(md5('x' || CAST(o_orderkey AS VARCHAR)), 1, 6))
  ELSE {_name('o_custkey')} END"""


def _grams(texts: str) -> str:
    return f"""SELECT match_text, gram, count(*) AS tf FROM (
      SELECT match_text, unnest(list_transform(range(1, length(match_text) + 1),
             lambda i: substr(' ' || match_text || ' ', i, 3))) AS gram
      FROM (SELECT DISTINCT match_text FROM {texts})) GROUP BY ALL"""


def _weights(grams: str) -> str:
    return f"""SELECT match_text, gram, w / sqrt(sum(w * w) OVER (PARTITION BY match_text)) AS weight FROM (
      SELECT g.match_text, g.gram,
             g.tf * (ln((1.0::DOUBLE + n.n) / (1.0::DOUBLE + coalesce(d.df, 0))) + 1.0::DOUBLE) AS w
      FROM {grams} g LEFT JOIN df d USING (gram), n_texts n)"""


def _cut(pairs: str) -> str:
    """Pairs with the sorted words of a and b, those that both have, and those that one has alone."""
    sort = "array_to_string(list_sort({}), ' ')"
    return f"""SELECT *, length(shared) AS ns, length(da) AS na, length(db) AS nb
      FROM (SELECT *, {sort.format("ta")} AS sa, {sort.format("tb")} AS sb,
                   {sort.format("list_filter(ta, lambda w: NOT list_contains(tb, w))")} AS da,
                   {sort.format("list_filter(tb, lambda w: NOT list_contains(ta, w))")} AS db,
                   {sort.format("list_filter(ta, lambda w: list_contains(tb, w))")} AS shared
            FROM (SELECT *, list_distinct({_words("a")}) AS ta, list_distinct({_words("b")}) AS tb FROM {pairs}))"""


def _ratios(pairs: str) -> str:
    """Pairs with every ratio of the columns a and b."""
    return f"""SELECT *,
      {_ratio('a', 'b', 'm_ab')} AS ratio,
      CASE WHEN a = '' AND b = '' THEN 100.0::DOUBLE WHEN a = '' OR b = '' THEN 0.0::DOUBLE
           WHEN length(a) < length(b) THEN {_windows('a', 'b', 'm_ab')}
           WHEN length(a) > length(b) THEN {_windows('b', 'a', 'm_ba')}
           ELSE greatest({_windows('a', 'b', 'm_ab')}, {_windows('b', 'a', 'm_ba')}) END AS partial_ratio,
      {_ratio('sa', 'sb', 'm_sorted')} AS token_sort_ratio,
      CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0::DOUBLE
           WHEN ns > 0 AND (na = 0 OR nb = 0) THEN 100.0::DOUBLE
           WHEN ns > 0 THEN greatest(
             100.0::DOUBLE * (2 * ns + 2 + na + nb - (na + nb - 2 * l_own)) / (2 * ns + 2 + na + nb),
             100.0::DOUBLE * (2 * ns + 1 + na - (1 + na)) / (2 * ns + 1 + na),
             100.0::DOUBLE * (2 * ns + 1 + nb - (1 + nb)) / (2 * ns + 1 + nb))
           ELSE 100.0::DOUBLE * (na + nb - (na + nb - 2 * l_own)) / (na + nb) END AS token_set_ratio
    FROM (SELECT *, {_masks('a', 'b')} AS m_ab, {_masks('b', 'a')} AS m_ba, {_masks('sa', 'sb')} AS m_sorted,
                 {_lcs('length(da)', _masks('da', 'db'))} AS l_own
          FROM ({_cut(pairs)}))"""


def _common(a: str, b: str) -> str:
    """The most characters two texts can have in common: letter by letter, all others together."""
    count = "length({0}) - length(replace({0}, x, ''))"
    each = f"list_transform({_list([*COUNTED])}, lambda x: least({count.format(a)}, {count.format(b)}))"
    other = f"length(translate({{0}}, '{COUNTED}', ''))"
    return f"(CAST(list_sum({each}) AS BIGINT) + least({other.format(a)}, {other.format(b)}))"


def _bounds(pairs: str) -> str:
    """Pairs with the least and greatest fuzzy score that their letters and words allow."""
    share = lambda common, total: f"CASE WHEN {total} = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {common} / ({total}) END"
    short = "least(length(a), length(b))"
    by_words = lambda common: f"""CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0::DOUBLE
           WHEN ns > 0 AND (na = 0 OR nb = 0) THEN 100.0::DOUBLE
           WHEN ns > 0 THEN greatest(
             100.0::DOUBLE * (2 * ns + 2 + 2 * {common}) / (2 * ns + 2 + na + nb),
             100.0::DOUBLE * (2 * ns) / (2 * ns + 1 + na), 100.0::DOUBLE * (2 * ns) / (2 * ns + 1 + nb))
           ELSE 100.0::DOUBLE * (2 * {common}) / (na + nb) END"""  # noqa: E731
    return f"""SELECT *, {by_words('0')} AS fuzzy_low, greatest(
        {share(f'least(m, {short})', 'length(a) + length(b)')},
        CASE WHEN a = '' AND b = '' THEN 100.0::DOUBLE WHEN a = '' OR b = '' THEN 0.0::DOUBLE
             ELSE 200.0::DOUBLE * least(m, {short}) / ({short} + least(m, {short})) END,
        {share('least(m_sorted, length(sa), length(sb))', 'length(sa) + length(sb)')},
        {by_words('least(m_own, na, nb)')}) AS fuzzy_high
    FROM (SELECT *, {_common('a', 'b')} AS m, {_common('sa', 'sb')} AS m_sorted, {_common('da', 'db')} AS m_own
          FROM ({_cut(pairs)}))"""


FUZZY = "greatest(ratio, partial_ratio, token_sort_ratio, token_set_ratio)"


def _boost(a: str, b: str) -> str:
    pair = f"list_max(list_transform({a}, lambda p: list_max(list_transform({b}, lambda q: {_ratio('p', 'q', _masks('p', 'q'))}))))"
    return f"""CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE
      WHEN list_has_any({a}, {b}) THEN 3.0::DOUBLE WHEN {pair} >= 80 THEN 2.0::DOUBLE
      WHEN {pair} >= 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"""


BASE = """CASE WHEN similarity * 100.0::DOUBLE >= 80 THEN similarity * 100.0::DOUBLE * 0.7::DOUBLE + fuzzy_score * 0.3::DOUBLE
  WHEN similarity * 100.0::DOUBLE >= 60 THEN similarity * 100.0::DOUBLE * 0.5::DOUBLE + fuzzy_score * 0.5::DOUBLE
  ELSE similarity * 100.0::DOUBLE * 0.3::DOUBLE + fuzzy_score * 0.7::DOUBLE END"""
FINAL = """least(100.0::DOUBLE, CASE WHEN base_score >= 60 THEN base_score + city_boost
  WHEN base_score >= 40 THEN base_score + city_boost * 0.5::DOUBLE ELSE base_score + city_boost * 0.2::DOUBLE END)"""

def _scored(rows: str) -> str:
    return f"""SELECT *, {FINAL} AS final_score FROM (SELECT *, {BASE} AS base_score FROM ({rows}))"""


def _results(winner: str, backend: str) -> str:
    return f"""SELECT t.txn_id, w.company_id, t.narration AS transaction_text,
      coalesce(w.company_name, 'NO_MATCH') AS company_name,
      round_even(coalesce(w.similarity, 0.0::DOUBLE), 2) AS embedding_similarity,
      round_even(coalesce(w.fuzzy_score, 0.0::DOUBLE), 2) AS fuzzy_score,
      round_even(coalesce(w.city_boost, 0.0::DOUBLE), 2) AS city_boost,
      round_even(coalesce(w.final_score, 0.0::DOUBLE), 2) AS final_score,
      '{backend}' AS backend_used, array_to_string(m.cities, '|') AS txn_cities,
      coalesce(array_to_string(w.company_cities, '|'), '') AS company_cities,
      CASE WHEN w.company_id IS NULL THEN t.match_text ELSE {_detected('t.match_text')} END AS detected_company_name
      FROM t JOIN mentions m USING (match_text, loc_text) LEFT JOIN {winner}"""


# Common tables by name, each with the tables it reads.
CTES: dict[str, tuple[list[str], str]] = {
    "companies": ([], f"SELECT c_custkey AS company_id, {_name('c_custkey')} AS company_name FROM customer"),
    "narrations": ([], f"""SELECT o_orderkey AS txn_id, o_custkey AS true_company_id, o_totalprice AS amount,
      {_pick(X.CHANNELS, 'o_orderkey % 5')} || '/' || upper(substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 14))
      || '/' || {NARRATION_BODY} AS narration FROM orders"""),
    "c0": (["companies"], f"""SELECT company_id, company_name AS original_name,
      {_punct(_fold('company_name'))} AS cleaned_text, {_normalize('company_name')} AS normalized_text,
      {_loc('company_name')} AS loc_text FROM companies"""),
    "c": (["c0"], "SELECT *, coalesce(nullif(normalized_text, ''), cleaned_text) AS match_text FROM c0"),
    "t0": (["narrations"], f"""SELECT txn_id, true_company_id, narration, trim(narration) AS original,
      {_clean('narration')} AS filtered FROM narrations"""),
    "t1": (["t0"], f"""SELECT *, {_punct('filtered')} AS cleaned, {_normalize('filtered')} AS normalized,
      {_loc('filtered')} AS loc_text FROM t0"""),
    "t": (["t1"], "SELECT *, coalesce(nullif(normalized, ''), cleaned) AS match_text FROM t1"),
    "locs": (["c", "t"], f"""SELECT loc_text, {_first_of_each('suffixed')} AS suffixed, {_cities('loc_text')} AS major
      FROM (SELECT loc_text, {_suffixed('loc_text')} AS suffixed
            FROM (SELECT loc_text FROM c UNION SELECT loc_text FROM t))"""),
    "dictionary": (["locs"], "SELECT DISTINCT location FROM (SELECT unnest(suffixed) AS location FROM locs)"),
    "gazetteer": (["companies"], """SELECT DISTINCT array_to_string(list_slice(w, len(w) - n + 1, len(w)), ' ') AS location
      FROM (SELECT string_split(lower(company_name), ' ') AS w FROM companies), (SELECT unnest(range(1, 7)) AS n)
      WHERE n <= len(w) AND length(array_to_string(list_slice(w, len(w) - n + 1, len(w)), ' ')) BETWEEN 3 AND 29"""),
    "listed": (["locs", "gazetteer"], f"""SELECT loc_text, list(location ORDER BY spot, n) AS listed FROM (
      SELECT loc_text, location, spot, n,
             row_number() OVER (PARTITION BY loc_text, location ORDER BY spot, n) AS again
      FROM (SELECT loc_text, spot, n, array_to_string(list_slice(w, spot, spot + n - 1), ' ') AS location
            FROM (SELECT loc_text, {_words('loc_text')} AS w, unnest(range(1, len({_words('loc_text')}) + 1)) AS spot
                  FROM locs), (SELECT unnest(range(1, 7)) AS n)
            WHERE spot + n - 1 <= len(w)) JOIN gazetteer USING (location))
      WHERE again = 1 GROUP BY loc_text"""),
    "known": (["locs", "dictionary"], """SELECT loc_text, list(location ORDER BY location) AS known
      FROM locs JOIN dictionary ON length(location) > 3 AND contains(loc_text, location) GROUP BY loc_text"""),
    "cities": (["locs", "known"], f"""SELECT loc_text, {_first_of_each('every')} AS cities FROM (
      SELECT loc_text, list_concat(list_concat(suffixed, major), coalesce(known, [])) AS every
      FROM locs LEFT JOIN known USING (loc_text))"""),
    "cg": (["c"], _grams("c")),
    "tg": (["t"], _grams("t")),
    "df": (["cg"], "SELECT gram, count(*) AS df FROM cg GROUP BY gram"),
    "n_texts": (["c"], "SELECT count(DISTINCT match_text) AS n FROM c"),
    "cw": (["cg", "df", "n_texts"], _weights("cg")),
    "tw": (["tg", "df", "n_texts"], _weights("tg")),
    "wide_candidates": (["cw", "tw", "c"], f"""SELECT * FROM (
      SELECT match_text, company_id, similarity, CAST(row_number() OVER (
               PARTITION BY match_text ORDER BY similarity DESC, company_id) AS INTEGER) AS rank
      FROM (SELECT q.match_text, k.match_text AS company_text, round(sum(q.weight * k.weight), 9) AS similarity
            FROM tw q JOIN cw k USING (gram) GROUP BY ALL)
           JOIN (SELECT match_text AS company_text, company_id FROM c) USING (company_text)
      WHERE similarity >= {FLOOR}::DOUBLE) WHERE rank <= 20"""),
    "candidates": (["wide_candidates"], f"SELECT * FROM wide_candidates WHERE rank <= {MATCHES}"),
    "enriched": (["candidates", "c"], """SELECT k.*, c.original_name AS company_name, c.match_text AS company_text,
      c.loc_text AS company_loc FROM candidates k JOIN c USING (company_id)"""),
    "true_pairs": (["t", "c"], """SELECT t.txn_id, c.company_id, t.match_text, t.loc_text AS txn_loc,
      c.loc_text AS company_loc, t.match_text AS a, c.match_text AS b
      FROM t JOIN c ON t.true_company_id = c.company_id"""),
    "true_ratios": (["true_pairs"], _ratios("true_pairs")),
    "true_boost": (["true_pairs", "cities"], f"""SELECT txn_id, txn_cities, company_cities,
      {_boost('txn_cities', 'company_cities')} AS city_boost
      FROM (SELECT p.txn_id, x.cities AS txn_cities, y.cities AS company_cities FROM true_pairs p
            JOIN cities x ON x.loc_text = p.txn_loc JOIN cities y ON y.loc_text = p.company_loc)"""),
    "pairs": (["enriched"], "SELECT *, match_text AS a, company_text AS b FROM enriched"),
    "pair_ratios": (["pairs"], _ratios("pairs")),
    "mentions": (["t", "cities"], "SELECT DISTINCT match_text, loc_text, cities FROM t JOIN cities USING (loc_text)"),
    "boosts": (["mentions", "pairs", "cities"], f"""SELECT mine, theirs, {_boost('mine', 'theirs')} AS city_boost FROM (
      SELECT DISTINCT m.cities AS mine, y.cities AS theirs FROM mentions m JOIN pairs p USING (match_text)
      JOIN cities y ON y.loc_text = p.company_loc)"""),
    "scored": (["mentions", "pair_ratios", "cities", "boosts"], _scored(f"""
        SELECT m.match_text, m.loc_text, p.company_id, p.company_name, p.similarity,
               {FUZZY} AS fuzzy_score, b.city_boost, b.theirs AS company_cities
        FROM mentions m JOIN pair_ratios p USING (match_text) JOIN cities y ON y.loc_text = p.company_loc
        JOIN boosts b ON b.mine = m.cities AND b.theirs = y.cities""")),
    "winners": (["scored"], """SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY match_text, loc_text
      ORDER BY final_score DESC, similarity DESC, company_id) = 1"""),
    "results": (["t", "mentions", "winners"], _results("winners w USING (match_text, loc_text)", "sparse")),
    "near": ([], f"""SELECT q.vec_id AS mine, k.vec_id AS theirs, round(list_cosine_similarity(q.v, k.v), 9) AS similarity
      FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) q,
           (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) k"""),
    "near_companies": (["near", "c"], f"""SELECT * FROM (
      SELECT mine, company_id, similarity, match_text AS company_text, original_name AS company_name,
             loc_text AS company_loc,
             row_number() OVER (PARTITION BY mine ORDER BY similarity DESC, company_id) AS rank
      FROM near JOIN c ON c.company_id % (SELECT count(*) FROM embeddings) = near.theirs
      WHERE similarity >= {FLOOR}::DOUBLE) WHERE rank <= {MATCHES}"""),
    "near_rows": (["near_companies", "t", "cities"], """SELECT t.txn_id, t.match_text, x.cities AS mine,
      y.cities AS theirs, k.company_id, k.similarity, k.company_text, k.company_name
      FROM t JOIN near_companies k ON t.true_company_id % (SELECT count(*) FROM embeddings) = k.mine
      JOIN cities x ON x.loc_text = t.loc_text JOIN cities y ON y.loc_text = k.company_loc"""),
    "near_pairs": (["near_rows"], "SELECT DISTINCT match_text AS a, company_text AS b FROM near_rows"),
    "near_ratios": (["near_pairs"], _ratios("near_pairs")),
    "near_boosts": (["near_rows"], f"""SELECT mine, theirs, {_boost('mine', 'theirs')} AS city_boost
      FROM (SELECT DISTINCT mine, theirs FROM near_rows)"""),
    "near_scored": (["near_rows", "near_ratios", "near_boosts"], _scored(f"""
      SELECT n.txn_id, n.company_id, n.company_name, n.similarity, {FUZZY} AS fuzzy_score, b.city_boost,
             n.theirs AS company_cities
      FROM near_rows n JOIN near_ratios r ON r.a = n.match_text AND r.b = n.company_text
      JOIN near_boosts b USING (mine, theirs)""")),
    "near_winners": (["near_scored"], """SELECT * FROM near_scored QUALIFY row_number() OVER (
      PARTITION BY txn_id ORDER BY final_score DESC, similarity DESC, company_id) = 1"""),
    "near_results": (["t", "mentions", "near_winners"], _results("near_winners w USING (txn_id)", "exact")),
}


def sql(select: str, *needs: str) -> str:
    """The select with all common tables it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for before in CTES[name][0]:
            add(before)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order) + "\n" + select


def _text(expression: str) -> str:
    return sql(f"SELECT txn_id, {expression} AS text FROM narrations", "narrations")


_N = "narration"
_PIPE = "array_to_string({}, '|')"
_CANDIDATES = sql("SELECT match_text, company_id, similarity, rank FROM candidates", "candidates")
_ROWS = "txn_id, coalesce(company_id, -1) AS company_id, transaction_text, company_name"
_ALL = f"""SELECT {_ROWS}, embedding_similarity, fuzzy_score, city_boost, final_score, backend_used,
  txn_cities, company_cities, detected_company_name FROM"""

def _bank_scan() -> str:
    """Bank names removed by a scan over the words, one step at a time."""
    known = f"list_contains({_list(L.BANKS)}, {{}})"
    step = f"""SELECT txn_id, w, i, kept, {known.format("w[i]")} AS one,
        i + 1 <= len(w) AND {known.format("w[i] || ' ' || w[i + 1]")} AS two FROM scan WHERE i <= len(w)"""
    step = f"""SELECT *, CASE WHEN two THEN i + 1 ELSE i END AS j FROM ({step})"""
    step = f"""SELECT *, j + 2 <= len(w) AND {known.format("w[i] || ' ' || w[j + 1] || ' ' || w[j + 2]")} AS three FROM ({step})"""
    step = f"""SELECT txn_id, w, CASE WHEN three THEN j + 3 ELSE j + 1 END,
        CASE WHEN one OR two OR three THEN kept ELSE list_append(kept, w[i]) END FROM ({step})"""
    start = f"SELECT txn_id, string_split({_squeeze(_fold(_N))}, ' '), 1, []::VARCHAR[] FROM narrations"
    scan = f"scan(txn_id, w, i, kept) AS ({start} UNION ALL {step})"
    return sql("@", "narrations").replace("WITH ", "WITH RECURSIVE ", 1).replace(
        "\n@", f",\n{scan}\nSELECT txn_id, array_to_string(kept, ' ') AS text FROM scan WHERE i > len(w)")


def _lsh_sql() -> str:
    """Neighbours that share a bucket, with the planes made anew from their hashes."""
    opts = MatchOptions()
    tables = lsh_tables(opts.lsh_bits, FLOOR, opts.lsh_recall)
    return f"""WITH planes AS MATERIALIZED (
        SELECT p, d, CASE WHEN substring(md5('{opts.lsh_seed}|' || p || '|' || d), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS s
        FROM (SELECT unnest(range({tables * opts.lsh_bits})) AS p),
             (SELECT unnest(range((SELECT max(len(embedding)) FROM embeddings))) AS d)),
      parts AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings),
      sides AS MATERIALIZED (SELECT vec_id, p, sum(x * s) > 0 AS above FROM parts JOIN planes USING (d) GROUP BY vec_id, p),
      buckets AS MATERIALIZED (
        SELECT vec_id, p // {opts.lsh_bits} AS t, sum(CASE WHEN above THEN 1 << (p % {opts.lsh_bits})::INTEGER ELSE 0 END) AS code
        FROM sides GROUP BY vec_id, p // {opts.lsh_bits}),
      met AS (SELECT DISTINCT a.vec_id AS q, b.vec_id AS k FROM buckets a JOIN buckets b USING (t, code)),
      near AS (SELECT q, k, round(list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 9) AS similarity
        FROM met JOIN embeddings x ON x.vec_id = q JOIN embeddings y ON y.vec_id = k)
      SELECT * FROM (SELECT q AS txn_id, k AS company_id, similarity, CAST(row_number() OVER (
        PARTITION BY q ORDER BY similarity DESC, k) AS INTEGER) AS rank FROM near WHERE similarity >= {FLOOR}::DOUBLE) WHERE rank <= {MATCHES}"""


ORACLES = {
    "clean_noise": _text(_noise(_fold(_N))),
    "clean_codes_dates": _text(_codes(_fold(_N))),
    "clean_punct": _text(_punct(_fold(_N))),
    "clean_short_words": _text(_short(_punct(_fold(_N)))),
    "remove_banks": _bank_scan(),
    "clean_narration": _text(_clean(_N)),
    "clean_narration_off": _text(f"trim({_N})"),
    "clean_documents": "SELECT doc_id, lower(trim(regexp_replace(regexp_replace(text, "
                       r"'[^\p{L}\p{N}_\s\p{Z}]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g'))) AS text FROM documents",
    "detected_name": _text(_detected(_fold(_N))),
    "normalize_company": sql(f"SELECT company_id, {_normalize('company_name')} AS text FROM companies", "companies"),
    "preprocess_companies": sql(f"""SELECT company_id, original_name, cleaned_text, normalized_text, match_text,
      loc_text, {_PIPE.format(_words('match_text'))} AS tokens FROM c""", "c"),
    "preprocess_txns": sql(f"""SELECT txn_id, original, cleaned, normalized, match_text, loc_text,
      {_PIPE.format(_words('match_text'))} AS tokens FROM t""", "t"),
    "preprocess_txns_unfiltered": sql(f"""SELECT txn_id, original, cleaned, normalized,
      coalesce(nullif(normalized, ''), cleaned) AS match_text, loc_text
      FROM (SELECT txn_id, trim(narration) AS original, {_punct(_fold('narration'))} AS cleaned,
                   {_normalize('narration')} AS normalized, {_loc('narration')} AS loc_text
            FROM narrations)""", "narrations"),
    "location_text": _text(_loc(_N)),
    "suffix_locations": sql(f"SELECT loc_text, {_PIPE.format('suffixed')} AS suffix_locations FROM locs", "locs"),
    "major_cities": sql(f"SELECT loc_text, {_PIPE.format('major')} AS major_cities FROM locs", "locs"),
    "gazetteer_lookup": sql(f"SELECT loc_text, {_PIPE.format('listed')} AS gazetteer_locations FROM listed", "listed"),
    "named_locations": sql(f"""SELECT loc_text, array_to_string(list(name ORDER BY spot, name), '|') AS gazetteer_locations FROM (
        SELECT loc_text, name, min(spot) AS spot FROM (
          SELECT loc_text, lower(w[spot]) AS name, spot FROM (
            SELECT loc_text, w, unnest(range(1, len(w) + 1)) AS spot FROM (
              SELECT loc_text, string_split({_name('true_company_id')}, ' ') AS w FROM t)))
        WHERE length(name) BETWEEN 3 AND 29 GROUP BY loc_text, name) GROUP BY loc_text""", "t"),
    "discovered_lookup": sql(f"SELECT loc_text, {_PIPE.format('known')} AS known_locations FROM known", "known"),
    "location_dictionary": sql("SELECT location FROM dictionary", "dictionary"),
    "location_dictionary_learned": sql("""SELECT location FROM dictionary
      UNION SELECT unnest(listed) AS location FROM listed
      UNION SELECT lower(n_name) AS location FROM nation""", "dictionary", "listed"),
    "location_count": sql("SELECT count(*) AS discovered_locations FROM dictionary", "dictionary"),
    "location_roundtrip": sql("SELECT location FROM dictionary", "dictionary"),
    "extract_locations": sql(f"SELECT loc_text, {_PIPE.format('cities')} AS cities FROM cities", "cities"),
    "city_boost": sql(f"""SELECT txn_id, {_PIPE.format('txn_cities')} AS txn_cities,
      {_PIPE.format('company_cities')} AS company_cities, city_boost FROM true_boost""", "true_boost"),
    "fuzzy_ratio": sql("SELECT txn_id, ratio FROM true_ratios", "true_ratios"),
    "fuzzy_partial": sql("SELECT txn_id, partial_ratio FROM true_ratios", "true_ratios"),
    "fuzzy_token_sort": sql("SELECT txn_id, token_sort_ratio FROM true_ratios", "true_ratios"),
    "fuzzy_token_set": sql("SELECT txn_id, token_set_ratio FROM true_ratios", "true_ratios"),
    "fuzzy_max": sql(f"SELECT txn_id, {FUZZY} AS fuzzy_score FROM true_ratios", "true_ratios"),
    "fuzzy_parts": "SELECT p_partkey, ratio, partial_ratio, token_sort_ratio, token_set_ratio FROM (" + _ratios(
        """(SELECT x.p_partkey, lower(concat_ws(' ', x.p_name, x.p_type, x.p_brand)) AS a,
                 lower(concat_ws(' ', y.p_name, y.p_type, y.p_brand)) AS b
            FROM part x JOIN part y ON y.p_partkey = (x.p_partkey * 7 + 3) % (SELECT count(*) FROM part))""") + ")",
    "tfidf_vectors": sql("SELECT match_text, gram, round(weight, 6) AS weight FROM cw", "cw"),
    "topk_sparse": _CANDIDATES,
    "topk_sparse_joined": _CANDIDATES,
    "stored_index": _CANDIDATES,
    "stored_index_wider_k": sql("SELECT match_text, company_id, similarity, rank FROM wide_candidates", "wide_candidates"),
    "topk_dense": f"""SELECT * FROM (
      SELECT txn_id, company_id, similarity, CAST(row_number() OVER (
               PARTITION BY txn_id ORDER BY similarity DESC, company_id) AS INTEGER) AS rank
      FROM (SELECT q.vec_id AS txn_id, k.vec_id AS company_id,
                   round(list_cosine_similarity(q.v, k.v), 9) AS similarity
            FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) q,
                 (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) k)
      WHERE similarity >= {FLOOR}::DOUBLE) WHERE rank <= {MATCHES}""",
    "topk_probed": f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    near AS (
      SELECT v.vec_id, c.vec_id AS cell, list_cosine_similarity(v.e, c.e) AS raw, round(list_cosine_similarity(v.e, c.e), 9) AS s
      FROM v JOIN v c ON c.vec_id % 40 = 0),
    home AS (SELECT vec_id, cell, acos(greatest(-1.0, least(1.0, raw))) AS away FROM near
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cell) = 1),
    radii AS (SELECT cell, max(away) AS radius FROM home GROUP BY cell),
    probed AS (SELECT vec_id AS txn_id, cell FROM near JOIN radii USING (cell)
      WHERE cos(greatest(0.0, acos(greatest(-1.0, least(1.0, raw))) - radius)) >= {FLOOR}::DOUBLE - 1e-9
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cell) <= 4),
    found AS (
      SELECT txn_id, home.vec_id AS company_id, round(list_cosine_similarity(q.e, k.e), 9) AS similarity
      FROM probed JOIN home USING (cell) JOIN v q ON q.vec_id = txn_id JOIN v k ON k.vec_id = home.vec_id)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY txn_id ORDER BY similarity DESC, company_id) AS INTEGER) AS rank
      FROM found WHERE similarity >= {FLOOR}::DOUBLE) WHERE rank <= {MATCHES}""",
    "candidates_enriched": sql("""SELECT match_text, company_id, similarity, rank, company_name, company_text
      FROM enriched""", "enriched"),
    "score_tiers": sql(f"""SELECT txn_id, similarity, fuzzy_score, city_boost, base_score, {FINAL} AS final_score
      FROM (SELECT *, {BASE} AS base_score FROM (
        SELECT r.txn_id, coalesce(k.similarity, 0.0::DOUBLE) AS similarity, {FUZZY} AS fuzzy_score, b.city_boost
        FROM true_ratios r JOIN true_boost b USING (txn_id) LEFT JOIN candidates k USING (match_text, company_id)))""",
                       "true_ratios", "true_boost", "candidates"),
    "fuzzy_bounds": sql("SELECT txn_id, fuzzy_low, fuzzy_high FROM (" + _bounds("true_pairs") + ")", "true_pairs"),
    "contenders": sql(f"""WITH bounded AS ({_bounds("pairs")}),
      low AS (SELECT match_text, company_id, {FINAL} AS low FROM (SELECT *, {BASE} AS base_score, 0.0::DOUBLE AS city_boost
        FROM (SELECT *, fuzzy_low AS fuzzy_score FROM bounded))),
      high AS (SELECT match_text, company_id, {FINAL} AS high FROM (SELECT *, {BASE} AS base_score, 3.0::DOUBLE AS city_boost
        FROM (SELECT *, fuzzy_high AS fuzzy_score FROM bounded)))
      SELECT match_text, count(*) AS candidates, count(*) FILTER (high >= reached - 1e-6) AS scored
      FROM (SELECT *, max(low) OVER (PARTITION BY match_text) AS reached FROM low JOIN high USING (match_text, company_id))
      GROUP BY match_text""".replace("WITH bounded", ", bounded", 1), "pairs"),
    "location_runs": sql(f"""SELECT location, count(*) AS n, count(DISTINCT txn_id % 2) AS runs
      FROM (SELECT txn_id, unnest(list_distinct({_suffixed('loc_text')})) AS location FROM t) GROUP BY location""", "t"),
    "best_match": sql("""SELECT txn_id, company_id, company_name, final_score FROM results
      WHERE company_id IS NOT NULL""", "results"),
    "no_match": sql("""SELECT txn_id, final_score, txn_cities, company_cities, detected_company_name FROM results
      WHERE company_id IS NULL""", "results"),
    "ranked_results": sql("""SELECT txn_id, coalesce(company_id, -1) AS company_id, final_score,
      row_number() OVER (ORDER BY final_score DESC, txn_id) - 1 AS position FROM results""", "results"),
    "projected_output": sql(f"SELECT {_ROWS}, final_score FROM results", "results"),
    "confidence_filter": sql("""SELECT txn_id, CASE WHEN final_score >= 85 THEN company_id ELSE -1 END AS company_id,
      CASE WHEN final_score >= 85 THEN company_name ELSE 'NO_MATCH' END AS company_name,
      CASE WHEN final_score >= 85 THEN fuzzy_score ELSE 0.0::DOUBLE END AS fuzzy_score,
      CASE WHEN final_score >= 85 THEN final_score ELSE 0.0::DOUBLE END AS final_score FROM results""", "results"),
    "run_summary": sql("""SELECT count(*) AS total_results, count(company_id) AS matched,
      count(*) - count(company_id) AS unmatched,
      count(*) FILTER (company_id IS NOT NULL AND final_score >= 80) AS high_scores,
      count(*) FILTER (company_id IS NOT NULL AND final_score >= 60 AND final_score < 80) AS medium_scores,
      count(*) FILTER (company_id IS NOT NULL AND final_score < 60) AS low_scores,
      (SELECT count(*) FROM dictionary) AS discovered_locations FROM results""", "results", "dictionary"),
    "full_match": sql(f"{_ALL} results", "results"),
    "match_by_vectors": sql(f"{_ALL} near_results", "near_results"),
    "run_files": sql(f"""{_ALL} results""".replace("detected_company_name FROM", """detected_company_name,
      CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS txn_date, CAST(o.o_totalprice AS VARCHAR) AS amount FROM""")
      + " JOIN orders o ON o.o_orderkey = txn_id", "results"),
    "match_text_ids": sql("""SELECT 'TXN' || lpad(CAST(txn_id AS VARCHAR), 9, '0') AS txn_id,
      coalesce('EC' || lpad(CAST(company_id AS VARCHAR), 9, '0'), 'none') AS company_id, company_name, final_score
      FROM results""", "results"),
    "assign_ordinal": sql("""SELECT company_name, row_number() OVER (ORDER BY company_name) - 1 AS ordinal
      FROM companies""", "companies"),
    "csv_roundtrip": sql("""SELECT CAST(txn_id AS VARCHAR) AS txn_id, CAST(amount AS VARCHAR) AS amount, narration
      FROM narrations""", "narrations"),
    "rejected_rows": sql("""SELECT CASE WHEN line = '' THEN CAST(txn_id AS VARCHAR) ELSE '' END AS txn_id,
        CASE WHEN line = '' THEN day ELSE '' END AS txn_date, CASE WHEN line = '' THEN narration ELSE '' END AS narration, line
      FROM (SELECT txn_id, day, narration, CASE txn_id % 50 WHEN 0 THEN txn_id || ',' || narration
            WHEN 1 THEN txn_id || ',' || day || ',' || narration || ',more' ELSE '' END AS line
        FROM (SELECT o.o_orderkey AS txn_id, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS day, n.narration
              FROM narrations n JOIN orders o ON o.o_orderkey = n.txn_id))""", "narrations"),
    "resolve_columns": """SELECT 'part' AS table_name, 'Memo' AS narration_column, 'p_partkey' AS company_column,
        count(p_name) AS filled FROM part
      UNION ALL SELECT 'customer', 'Details', 'c_custkey', count(c_name) FROM customer
      UNION ALL SELECT 'supplier', 's_suppkey', 's_suppkey', count(s_suppkey) FROM supplier""",
    "company_table_roundtrip": sql(f"""SELECT company_id, original_name, cleaned_text, match_text AS normalized_text,
      {_PIPE.format('cities')} AS cities, {_PIPE.format(_words('match_text'))} AS tokens
      FROM c JOIN cities USING (loc_text)""", "c", "cities"),
    "topk_lsh": _lsh_sql(),
}

ORACLES["topk_dense_cells"] = ORACLES["topk_dense"]
ORACLES["run_files_summary"] = ORACLES["run_summary"]
ORACLES["index_after_changes"] = ORACLES["topk_sparse"].replace("FROM customer", "FROM customer WHERE c_custkey % 7 <> 3")
