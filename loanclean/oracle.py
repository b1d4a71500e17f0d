"""SQL with the results that the registered queries must give.

Written for an engine without Spark's functions, mostly row by row: all pairs of
a block are listed, every date layout is tried, numbers are assigned by one
global window. The texts check the Spark jobs; they are not how Spark runs them.
"""

from __future__ import annotations

import re

from loanclean import fixture
from loanclean.catalog import NOTE_WORDS
from loanclean.sources import loans as gen
from loanclean.values import (
    CANONICAL_PURPOSES,
    COMMA_SKIPS,
    CSV_NULLS,
    DATE_FORMATS,
    HOME_VARIANTS,
    LOAN_COLUMNS,
    MISSING_MARKERS,
    MISSING_PLAN,
    NOTE_TYPOS,
    NUMERIC_COLUMNS,
    PAIR_FIELDS,
    PHONE_SKIPS,
    PROFILED_COLUMNS,
    PURPOSE_VARIANTS,
)


def _texts(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _null_in(col: str, markers: list[str]) -> str:
    return f"case when {col} not in ({_texts(markers)}) then {col} end"


TABLES: dict[str, str] = {
    "loans": fixture.loans_sql(),
    "clean": fixture.clean_sql(),
    "layer2": fixture.layer2_sql(),
    "truth": "select customer_id, cast(true_app as varchar) as application_date, cast(true_iss as varchar) as issue_date from loans where customer_id like 'LC%'",
    "csv": "select " + ", ".join(f"{_null_in(c, CSV_NULLS)} as {c}" for c in LOAN_COLUMNS) + ", row_pos, k from loans",
    "marked": "select " + ", ".join(f"{_null_in(c, MISSING_MARKERS)} as {c}" for c in LOAN_COLUMNS) + ", row_pos from csv",
}


def _number(col: str, comma: bool = True) -> str:
    text = f"replace({col}, ',', '.')" if comma else col
    return f"case when not isnan(try_cast({text} as double)) then try_cast({text} as double) end"


TABLES["numbers"] = (
    "select customer_id, "
    + ", ".join(f"{_number(c)} as {c}" for c in NUMERIC_COLUMNS)
    + f", {_number('fico_score', False)} as fico_score from marked"
)
TABLES["ranged"] = """select customer_id, int_rate, installment,
  case when loan_amnt < 0 then null else loan_amnt end as loan_amnt,
  case when fico_score < 300 or fico_score > 850 then null else fico_score end as fico_score,
  case when dti > 100 then null else dti end as dti,
  case when annual_inc < 0 then null else annual_inc end as annual_inc from numbers"""
TABLES["homes"] = """select customer_id, case upper(trim(home_ownership)) when 'RENTED' then 'RENT' when 'MORTGAGED' then 'MORTGAGE'
  else upper(trim(home_ownership)) end as home_ownership from marked"""
TABLES["phones"] = """select customer_id, case when length(d) = 10 then substr(d, 1, 3) || '-' || substr(d, 4, 3) || '-' || substr(d, 7, 4) end as phone
  from (select customer_id, regexp_replace(phone, '[^0-9]', '', 'g') as d from marked) t"""
TABLES["grades"] = """select customer_id, nullif(regexp_extract(upper(trim(grade)), '[A-G]'), '') as first_letter,
  nullif(regexp_extract(upper(trim(grade)), '\\b[A-G]\\b'), '') as token from marked"""

# Longest common subsequence of (a, b) pairs, one table cell per step.
_LCS = """
  cells as (
    select a, b, 1 as i, 1 as j, list_transform(range(length(b) + 1), lambda x: 0) as prev, [0] as cur from pairs_ab
    union all
    select a, b,
      case when j > length(b) then i + 1 else i end,
      case when j > length(b) then 1 else j + 1 end,
      case when j > length(b) then cur else prev end,
      case when j > length(b) then [0]
           else list_append(cur, case when substr(a, i, 1) = substr(b, j, 1) then prev[j] + 1 else greatest(prev[j + 1], cur[j]) end) end
    from cells where i <= length(a)
  ),
  lcs as (select a, b, 200.0 * prev[length(b) + 1] / (length(a) + length(b)) as ratio from cells where i = length(a) + 1)"""

_CHOICES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CANONICAL_PURPOSES))
_MATCHED = f"""
  raw_purposes as (select distinct replace(replace(lower(trim(purpose)), ' ', '_'), '-', '_') as a from marked where purpose is not null),
  choices(pos, b) as (values {_CHOICES}),
  pairs_ab as (select a, b from raw_purposes, choices), {_LCS},
  best as (
    select a, b from (
      select lcs.a, lcs.b, ratio, row_number() over (partition by lcs.a order by ratio desc, pos) as r
      from lcs join choices on lcs.b = choices.b) t
    where r = 1 and ratio >= 80),
  purposes as (
    select m.customer_id, m.purpose as purpose_original, best.b as purpose
    from marked m left join best on replace(replace(lower(trim(m.purpose)), ' ', '_'), '-', '_') = best.a)"""


def _with(*names: str, extra: str = "", recursive: bool = False) -> str:
    """WITH clause of the named tables and all they build on, in order."""
    order = list(TABLES)
    needed = set(names)
    for name in reversed(order):
        if name in needed:
            needed |= {o for o in order[: order.index(name)] if _uses(TABLES[name], o)}
    parts = [f"{n} as ({TABLES[n]})" for n in order if n in needed]
    if extra:
        parts.append(extra.strip())
    return ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n"


def _uses(sql: str, table: str) -> bool:
    return re.search(rf"\b(?:from|join)\s+{table}\b", sql) is not None


# ------------------------------------------------------------------ mixed files

TABLES["mixed"] = fixture.mixed_sql()


def _by_name(column: str) -> str:
    """The column as its file gives it: null where the header lacks it or the row is cut off before it."""
    gone = [f"layout = {i}" if column not in names else f"(layout = {i} and fault = 'short')" for i, names in enumerate(fixture.MIXED_LAYOUTS) if column not in names or names[-1] == column]
    return f"case when {' or '.join([*gone, 'false'])} then null else {column} end"


_MIXED = ", ".join(f"{_null_in(_by_name(c), CSV_NULLS)} as {c}" for c in fixture.MIXED_COLUMNS)
_REJECTED = f"""select fault as reason, cast(case fault when 'short' then 4 else 6 end as int) as n_cells, cast(5 as int) as expected, record,
  {_by_name('customer_id')} as customer_id from mixed where fault is not null"""

# ------------------------------------------------------------------ date tables


def _found(col: str) -> str:
    tries = ", ".join(f"cast(try_strptime(trim({col}), '{f}') as date)" for f in DATE_FORMATS)
    return f"list_sort(list_distinct(list_filter([{tries}], lambda x: x is not null)))"


TABLES["found"] = f"select customer_id, {_found('application_date')} as fa, {_found('issue_date')} as fi from csv"
TABLES["firsts"] = "select customer_id, unnest(fa) as a, fi from found"
TABLES["both_dates"] = "select customer_id, a, unnest(fi) as b from firsts"
TABLES["fits"] = "select customer_id, a, b, b - a as gap from both_dates where b - a between 1 and 30"
TABLES["fit_counts"] = """select csv.customer_id, count(fits.a) as n, min(fits.a) as a, min(fits.b) as b,
  min({'gap': fits.gap, 'a': fits.a, 'b': fits.b}) as smallest from csv left join fits on csv.customer_id = fits.customer_id group by csv.customer_id"""
TABLES["solved"] = """select customer_id, case when n = 1 then cast(a as varchar) end as solved_application_date,
  case when n = 1 then cast(b as varchar) end as solved_issue_date, n <> 1 as is_ambiguous from fit_counts"""
TABLES["smallest_gap"] = """select customer_id, case when n > 0 then cast(smallest.a as varchar) end as solved_application_date,
  case when n > 0 then cast(smallest.b as varchar) end as solved_issue_date, n = 0 as is_ambiguous from fit_counts"""
TABLES["overlaid"] = """select l.customer_id, case when s.is_ambiguous = false then s.solved_application_date else l.application_date end as application_date,
  case when s.is_ambiguous = false then s.solved_issue_date else l.issue_date end as issue_date, l.advisor_notes
  from layer2 l left join solved s on l.customer_id = s.customer_id"""
TABLES["gaps"] = """select *, try_cast(issue_date as date) - try_cast(application_date as date) as gap_days from layer2"""
TABLES["broken"] = "select * from gaps where gap_days is null or gap_days not between 1 and 30"
TABLES["min_gap_updates"] = """select customer_id, solved_application_date as application_date, solved_issue_date as issue_date
  from smallest_gap where not is_ambiguous and customer_id in (select customer_id from broken)"""
TABLES["min_gap_layer2"] = """select l.customer_id, coalesce(u.application_date, l.application_date) as application_date,
  coalesce(u.issue_date, l.issue_date) as issue_date, l.advisor_notes
  from layer2 l left join min_gap_updates u on l.customer_id = u.customer_id"""

# --------------------------------------------------------------- linkage tables

TABLES["link"] = """select * from (select customer_id as id, row_pos as pos,
  nullif(upper(regexp_extract(trim(full_name), '[^ ]+$')), '') as last_name, zip_code, full_name, email, phone, street_address from csv) t
  where last_name is not null and zip_code is not null"""


def _scored(source: str, keep: str) -> str:
    jw = {c: f"coalesce(jaro_winkler_similarity(a.{c}, b.{c}), 0)" for c in ("full_name", "email", "street_address")}
    return f"""select *, case when total_score >= 2.6 then 'auto_dup' when total_score >= 2.3 then 'gray' else 'auto_not' end as decision
      from (select *, round(name_score + email_score + phone_score + address_score, 9) as total_score from (
        select a.id as id_a, b.id as id_b, a.pos as pos_a, b.pos as pos_b, {keep}
          {jw['full_name']} as name_score, {jw['email']} as email_score,
          case when a.phone = b.phone then 1.0 else 0.0 end as phone_score, {jw['street_address']} as address_score
        from {source} a join {source} b on a.last_name = b.last_name and a.zip_code = b.zip_code and a.pos > b.pos) s) t"""


TABLES["row_pairs"] = _scored("link", "a.street_address = b.street_address as same_address,")
TABLES["profiles"] = """select last_name, zip_code, full_name, email, phone, street_address, count(*) as n, min(pos) as pos,
  arg_min(id, pos) as id, arg_max(id, pos) as last_id from link group by all"""
TABLES["cross_pairs"] = _scored("profiles", "cast(a.n * b.n as bigint) as n_pairs,")
TABLES["copy_pairs"] = """select *, case when total_score >= 2.6 then 'auto_dup' when total_score >= 2.3 then 'gray' else 'auto_not' end as decision from (
    select *, name_score + email_score + phone_score + address_score as total_score from (
      select last_id as id_a, id as id_b, cast(n * (n - 1) / 2 as bigint) as n_pairs,
        case when length(full_name) > 0 then 1.0 else 0.0 end as name_score, case when length(email) > 0 then 1.0 else 0.0 end as email_score,
        case when phone is not null then 1.0 else 0.0 end as phone_score, case when length(street_address) > 0 then 1.0 else 0.0 end as address_score
      from profiles where n > 1) s) t"""
_PAIR_OUT = (
    "id_a, id_b, round(name_score, 9) as name_score, round(email_score, 9) as email_score, cast(phone_score as double) as phone_score, "
    "round(address_score, 9) as address_score, cast(total_score as double) as total_score, decision, n_pairs"
)
TABLES["profile_pairs"] = f"select {_PAIR_OUT} from cross_pairs where decision <> 'auto_not' union all select {_PAIR_OUT} from copy_pairs where decision <> 'auto_not'"
TABLES["flags"] = """select id, arg_max(partner, rank) as duplicate_of from (
    select id_a as id, id_b as partner, pos_b + case when decision = 'gray' then 1000000000000 else 0 end as rank
    from row_pairs where decision = 'auto_dup' or (decision = 'gray' and same_address)
    union all select id_a, max(id_b), 2000000000000 from profile_pairs where decision = 'gray' and address_score = 1 group by id_a) r group by id"""
TABLES["crowded"] = f"""select * from (select customer_id as id, row_pos as pos, nullif(upper(regexp_extract(trim(full_name), '[^ ]+$')), '') as last_name, zip_code,
  full_name, email, phone, street_address from (select customer_id, row_pos, {", ".join(f"{_null_in(c, CSV_NULLS)} as {c}" for c in ("full_name", "email", "phone", "street_address", "zip_code"))}
  from ({fixture.crowded_sql()}) people) t) named where last_name is not null and zip_code is not null"""
TABLES["crowded_rows"] = _scored("crowded", "")
TABLES["numbered"] = "select *, row_number() over (order by row_pos) - 1 as idx from csv"

# ------------------------------------------------------------------- draws in SQL


def _num(seed: int, name: str, key: str, part: int) -> str:
    return f"('0x' || substr(md5('{seed}:{name}:' || cast({key} as varchar)), {1 + 8 * part}, 8))::bigint"


def _uni(seed: int, name: str, key: str, part: int) -> str:
    return f"({_num(seed, name, key, part)} / 4294967296.0::double)"


def _norm(seed: int, name: str, key: str, part: int) -> str:
    u = f"(({_num(seed, name, key, part)} + 1) / 4294967296.0::double)"
    return f"(sqrt(-2 * ln({u})) * cos(2 * pi() * {_uni(seed, name, key, part + 1)}))"


def _one_of(values: list[str], number: str) -> str:
    return f"([{_texts(values)}])[cast({number} % {len(values)} + 1 as int)]"


def _weighted(values: list[str], weights: list[float], u: str) -> str:
    total, whens = 0.0, []
    for v, w in list(zip(values, weights))[:-1]:
        total = round(total + w, 10)
        whens.append(f"when {u} < {total}::double then '{v}'")
    return f"case {' '.join(whens)} else '{values[-1]}' end"


_C = "customer_id"


def _dirty_num(name: str, part: int) -> str:
    return _num(7, name, _C, part)


def _dirty_uni(name: str, part: int) -> str:
    return _uni(7, name, _C, part)


def _variants(col: str, variants: dict[str, list[str]], share: float) -> str:
    name = f"variant/{col}"
    whens = " ".join(f"when {col} = '{v}' then {_one_of(s, _dirty_num(name, 0))}" for v, s in variants.items())
    return f"case when {_dirty_uni(name + '/rows', 0)} < {share}::double and {col} in ({_texts(list(variants))}) then case {whens} end else {col} end"


def _noise() -> str:
    text = "advisor_notes"
    for i, (right, wrong) in enumerate(NOTE_TYPOS):
        text = f"case when {_dirty_uni(f'noise/typo{i // 4}', i % 4)} < 0.5 then replace({text}, '{right}', '{wrong}') else {text} end"
    return (
        f"select {_C}, case when not hit then old when u0 < 0.3::double then upper(t) when u1 < 0.3::double then '  ' || t || '   ' else t end as advisor_notes "
        f"from (select {_C}, advisor_notes as old, {text} as t, {_dirty_uni('noise/rows', 0)} < 0.2::double as hit, "
        f"{_dirty_uni('noise/style', 0)} as u0, {_dirty_uni('noise/style', 1)} as u1 from clean) x"
    )


def _phone() -> str:
    p = ["substr(d, 1, 3)", "substr(d, 4, 3)", "substr(d, 7, 4)"]
    layouts = [
        f"concat('(', {p[0]}, ') ', {p[1]}, '-', {p[2]})",
        f"concat({p[0]}, '.', {p[1]}, '.', {p[2]})",
        f"concat({p[0]}, '-', {p[1]}, '-', {p[2]})",
        f"concat({p[0]}, {p[1]}, {p[2]})",
    ]
    whens = " ".join(f"when {i} then {x}" for i, x in enumerate(layouts))
    return (
        f"select {_C}, case when hit and length(d) = 10 then case w {whens} end else phone end as phone from (select {_C}, phone, "
        f"regexp_replace(phone, '[^0-9]', '', 'g') as d, {_dirty_num('phone', 0)} % 4 as w, {_dirty_uni('phone/rows', 0)} < 0.3::double as hit from clean) x"
    )


def _messy_date(col: str) -> str:
    formats = ["%Y-%m-%d", "%d/%m/%Y", "%m-%d-%Y", "%d %b %Y", "%Y/%m/%d"]
    name = f"date_format/{col}"
    whens = " ".join(f"when {i} then strftime(cast({col} as date), '{f}')" for i, f in enumerate(formats))
    return f"case when {_dirty_uni(name + '/rows', 0)} < 0.5::double then case {_dirty_num(name, 0)} % 5 {whens} end else {col} end"


def _outlier(col: str, new: str) -> str:
    return f"case when {_dirty_uni(f'outlier/{col}/rows', 0)} < 0.01::double then {new} else {col} end as {col}"


def _dirt_log() -> str:
    hit = {f"{c}_missing": f"{_dirty_uni(f'missing/{c}/rows', 0)} < {s}::double" for c, s, _ in MISSING_PLAN}
    cols = [f"{v} as {n}" for n, v in hit.items()]
    for c, _, markers in MISSING_PLAN:
        marker = _one_of(markers, _dirty_num(f"missing/{c}", 0))
        cols.append(f"case when {hit[c + '_missing']} then {marker} else {c} end as now_{c}")
    parts = [("missing_marker", c, f"{c}_missing") for c, _, _ in MISSING_PLAN]
    shares = [("date_format", c, f"date_format/{c}", 0.5) for c in ("application_date", "issue_date")]
    shares += [("category_variant", "home_ownership", "variant/home_ownership", 0.15), ("category_variant", "grade", "variant/grade", 0.10)]
    shares += [("text_noise", "advisor_notes", "noise", 0.2), ("outlier_negative", "loan_amnt", "outlier/loan_amnt", 0.01)]
    shares += [("outlier_impossible", c, f"outlier/{c}", 0.01) for c in ("fico_score", "dti")]
    rows = [f"select '{c}' as \"column\", '{t}' as dirt_type, count(*) filter ({h}) as n from d" for t, c, h in parts]
    for kind, col, name, share in shares:
        rows.append(f"select '{col}', '{kind}', count(*) filter ({_dirty_uni(name + '/rows', 0)} < {share}::double) from d")
    variants = _texts(list(PURPOSE_VARIANTS))
    rows.append(f"select 'purpose', 'category_variant', count(*) filter ({_dirty_uni('variant/purpose/rows', 0)} < 0.1::double and purpose in ({variants})) from d")
    for col in ("loan_amnt", "int_rate", "dti", "annual_inc"):
        now = f"now_{col}" if col in ("dti", "annual_inc") else col
        rows.append(
            f"select '{col}', 'decimal_comma', count(*) filter ({_dirty_uni(f'comma/{col}/rows', 0)} < 0.08::double and {now} not in ({_texts(COMMA_SKIPS)})) from d"
        )
    rows.append(f"select 'phone', 'phone_format', count(*) filter ({_dirty_uni('phone/rows', 0)} < 0.3::double and now_phone not in ({_texts(PHONE_SKIPS)})) from d")
    return _with("clean", extra=f"d as (select *, {', '.join(cols)} from clean)") + f"select * from ({' union all '.join(rows)}) t where n > 0"


def _gen_loans() -> str:
    def n(name, part):
        return _num(42, name, "k", part)

    def u(name, part):
        return _uni(42, name, "k", part)

    def z(name, part):
        return _norm(42, name, "k", part)

    def by_grade(levels):
        return "case grade " + " ".join(f"when '{g}' then {v}::double" for g, v in zip(gen.GRADES, levels)) + " end"

    def digits(x, width):
        return f"lpad(cast({x} % {10**width} as varchar), {width}, '0')"

    base = f"""base as (select o_orderkey as k,
      round(least(greatest(exp(9.5::double + 0.45::double * {z('money', 0)}), 1000), 40000) / 50) * 50 as loan_amnt,
      {_weighted(gen.GRADES, gen.GRADE_SHARES, u('class', 0))} as grade,
      {z('money', 2)} * 1.2::double as rate_noise,
      round(least(greatest(exp(11.0::double + 0.5::double * {z('income', 0)}), 15000), 400000), 2) as annual_inc,
      {z('income', 2)} * 12.0::double as fico_noise,
      {_weighted(gen.EMP_LENGTHS, gen.EMP_LENGTH_SHARES, u('kind', 2))} as emp_length,
      {_one_of(gen.FIRST_NAMES, n('person', 0))} as f, {_one_of(gen.LAST_NAMES, n('person', 1))} as l,
      date '2015-01-01' + cast({n('time', 0)} % {gen.ISSUE_DAYS} as int) as issue from orders),
    terms as (select *, round(least(greatest({by_grade(gen.GRADE_RATES)} + rate_noise, 5.31::double), 30.99::double), 2) as int_rate,
      case when {u('class', 1)} < least(greatest((loan_amnt - 5000) / 35000, 0.1::double), 0.75::double) then 60 else 36 end as term_months,
      cast(trunc(least(greatest({by_grade(gen.GRADE_FICO)} + fico_noise, 600), 850)) as int) as fico_score from base),
    pay as (select *, round(loan_amnt * ((int_rate / 100 / 12) * pow(1 + int_rate / 100 / 12, term_months)) / (pow(1 + int_rate / 100 / 12, term_months) - 1), 2) as installment from terms)
    """
    out = f"""select 'LC' || cast(k + 100000 as varchar) as customer_id, f || ' ' || l as full_name,
      lower(f || '.' || l || cast({n('person', 2)} % 998 + 1 as varchar) || '@' || {_one_of(gen.MAIL_HOSTS, n('person', 3))}) as email,
      {digits(n('contact', 0), 3)} || '-' || {digits(n('place', 2), 3)} || '-' || {digits(n('contact', 1), 4)} as phone,
      cast(1 + {n('contact', 2)} % 9999 as varchar) || ' ' || {_one_of(gen.STREETS, n('contact', 3))} || ' ' || {_one_of(gen.STREET_KINDS, n('street', 0))} as street_address,
      {_one_of(gen.CITIES, n('place', 0))} as city, {_one_of(gen.STATES, n('place', 1))} as state,
      lpad(cast(1 + {n('place', 3)} % 99950 as varchar), 5, '0') as zip_code,
      loan_amnt, term_months, int_rate, installment, grade, {_one_of(gen.JOBS, n('work', 0))} as emp_title, emp_length,
      {_weighted(gen.HOME_OWNERSHIP, gen.HOME_SHARES, u('class', 3))} as home_ownership, annual_inc,
      {_weighted(gen.VERIFICATION, gen.VERIFICATION_SHARES, u('kind', 0))} as verification_status,
      {_weighted(CANONICAL_PURPOSES, gen.PURPOSE_SHARES, u('kind', 1))} as purpose,
      round(least(greatest((installment + annual_inc / 12 * (0.05::double + {u('class', 2)} * 0.25::double)) / (annual_inc / 12) * 100, 0), 45), 2) as dti,
      fico_score, {_weighted(gen.LOAN_STATUS, gen.LOAN_STATUS_SHARES, u('kind', 3))} as loan_status,
      cast(issue - cast(1 + {n('time', 1)} % 29 as int) as varchar) as application_date, cast(issue as varchar) as issue_date,
      replace({_one_of(gen.NOTE_TEMPLATES, n('work', 1))}, '{{emp_len}}', emp_length) as advisor_notes from pay"""
    return "with " + base + out


# ------------------------------------------------------------------- the queries

_ALL = ", ".join(LOAN_COLUMNS)
_JSON_RECORD = "{'customer_id': customer_id, 'application_date': application_date, 'issue_date': issue_date, 'advisor_notes': advisor_notes}"


def _pair_json(alias: str) -> str:
    return "to_json({" + ", ".join(f"'{c}': {alias}.{c}" for c in PAIR_FIELDS) + "})"


def _count_rows(stage: str, metrics: dict[str, str], table: str) -> str:
    return " union all ".join(f"select '{stage}' as stage, '{m}' as metric, {v} as value from {table}" for m, v in metrics.items())


def _delta(column: str, before: str, after: str) -> str:
    return (
        f"select '{column}' as \"column\", count(*) filter ({before} is null) as \"before\", count(*) filter ({after} is null) as \"after\", "
        f"count(*) filter ({after} is null) - count(*) filter ({before} is null) as added from joined"
    )


def _notes(known: list[str]) -> str:
    squeezed = "trim(regexp_replace(advisor_notes, '\\s+', ' ', 'g'))"
    fixed = "case when s = upper(s) and s <> lower(s) then upper(substr(lower(s), 1, 1)) || substr(lower(s), 2) else s end"
    for right, wrong in NOTE_TYPOS:
        fixed = f"regexp_replace(replace({fixed}, '{wrong.capitalize()}', '{right.capitalize()}'), '{wrong}', '{right}', 'gi')"
    words = _texts(known)
    return (
        f"select customer_id, advisor_notes, coalesce(len(list_filter(regexp_extract_all(lower(advisor_notes), '([a-z]+)', 1), "
        f"lambda w: not list_contains([{words}], w))) > 0, false) as needs_review from (select customer_id, {fixed} as advisor_notes "
        f"from (select customer_id, {squeezed} as s from csv) a) b"
    )


_ERR = """errors as (select l.customer_id, l.application_date as application_date_got, t.application_date as application_date_truth,
    l.issue_date as issue_date_got, t.issue_date as issue_date_truth,
    try_cast(l.application_date as date) as ag, cast(t.application_date as date) as ta,
    try_cast(l.issue_date as date) as ig, cast(t.issue_date as date) as ti
  from layer2 l join truth t on l.customer_id = t.customer_id
  where coalesce(try_cast(l.application_date as date) <> cast(t.application_date as date), true)
     or coalesce(try_cast(l.issue_date as date) <> cast(t.issue_date as date), true))"""


def _accuracy(table: str, app: str = "application_date", iss: str = "issue_date", where: str = "true") -> str:
    def one(col, got):
        right = f"count(*) filter (try_cast(x.{got} as date) = cast(t.{col} as date))"
        return (
            f"select '{col}' as \"column\", {right} as correct, count(*) as total, round({right} * 100.0::double / count(*), 3) as pct "
            f"from {table} x join truth t on x.customer_id = t.customer_id where {where}"
        )

    return one("application_date", app) + " union all " + one("issue_date", iss)


_METRICS = _count_rows(
    "layer1",
    {"rows": "count(*)", "null_phone": "count(*) filter (phone is null)", "null_loan_amnt": "count(*) filter (loan_amnt is null)", "null_dti": "count(*) filter (dti is null)"},
    "(select p.phone, r.loan_amnt, r.dti from phones p join ranged r on p.customer_id = r.customer_id) q",
) + " union all " + _count_rows(
    "dates", {"rows": "count(*)", "confident": "count(*) filter (not is_ambiguous)", "ambiguous": "count(*) filter (is_ambiguous)"}, "solved"
) + " union all " + _count_rows(
    "final",
    {"rows": "count(*)", "flagged": "count(*) filter (duplicate_of is not null)", "null_issue_date": "count(*) filter (issue_date is null)"},
    "(select f.duplicate_of, o.issue_date from csv c left join overlaid o on c.customer_id = o.customer_id left join flags f on c.customer_id = f.id) q",
)

_FINAL_ROWS = "(select f.duplicate_of, o.issue_date from csv c left join overlaid o on c.customer_id = o.customer_id left join flags f on c.customer_id = f.id) q"
_SAVED = " union all ".join(
    [
        _count_rows("final", {"rows": "count(*)", "flagged": "count(duplicate_of)", "null_issue_date": "count(*) filter (issue_date is null)"}, _FINAL_ROWS),
        _count_rows("layer2", {"rows": "count(*)", **{f"null_{c}": f"count(*) filter ({c} is null)" for c in ("application_date", "issue_date")}}, "overlaid"),
        _count_rows("pairs", {"rows": "count(*)"}, "profile_pairs"),
        _count_rows("pairs", {kind: f"count(*) filter (decision = '{kind}')" for kind in ("auto_dup", "gray")}, "row_pairs"),
    ]
)

_FINAL_DATES = "dated as (select c.customer_id, o.application_date, o.issue_date from csv c left join overlaid o on c.customer_id = o.customer_id)"
_MESSY = f"""truth as (select customer_id, application_date, issue_date from clean),
  messy as (select customer_id, {_messy_date('application_date')} as application_date, {_messy_date('issue_date')} as issue_date from clean),
  messy_found as (select customer_id, {_found('application_date')} as fa, {_found('issue_date')} as fi from messy),
  messy_firsts as (select customer_id, unnest(fa) as a, fi from messy_found),
  messy_both as (select customer_id, a, unnest(fi) as b from messy_firsts),
  messy_solved as (select customer_id, cast(min(a) as varchar) as application_date, cast(min(b) as varchar) as issue_date
    from messy_both where b - a between 1 and 30 group by 1 having count(*) = 1)"""

_LAYER1_COLUMNS = {
    **{c: f"m.{c}" for c in LOAN_COLUMNS},
    **{c: f"r.{c}" for c in [*NUMERIC_COLUMNS, "fico_score"]},
    "home_ownership": "h.home_ownership", "grade": "g.token", "phone": "ph.phone", "purpose": "pu.purpose", "purpose_original": "pu.purpose_original",
}
_LAYER1_FROM = """from marked m join ranged r on m.customer_id = r.customer_id join homes h on m.customer_id = h.customer_id
  join grades g on m.customer_id = g.customer_id join phones ph on m.customer_id = ph.customer_id join purposes pu on m.customer_id = pu.customer_id"""
_LAYER1_TABLES = ("marked", "ranged", "homes", "grades", "phones")
_FINAL_COLUMNS = {c: v for c, v in _LAYER1_COLUMNS.items() if c not in ("application_date", "issue_date", "advisor_notes")}

_BATCHED = "requests as (select idx // 100 as batch_id, count(*) as n, to_json(list(" + _JSON_RECORD + " order by idx)) as request from numbered group by all)"

# Rounds of asking: batches that fail are halved, the first half having as many records or one more.
_FAILS = "n > 30 and cast(right(head, 1) as int) % 2 = 0"


def _round(number: int, rows: str) -> str:
    """Rows (batch_id, j, customer_id) of a round with their batch's size and first customer."""
    return f"""round{number} as (select *, count(*) over (partition by batch_id) as n, first(customer_id) over (partition by batch_id order by j) as head
      from ({rows}) rows)"""


def _halved(number: int) -> str:
    half = "(n + 1) // 2"
    return f"select batch_id * 2 + case when j >= {half} then 1 else 0 end as batch_id, case when j >= {half} then j - {half} else j end as j, customer_id from round{number} where {_FAILS}"


_ROUNDS = ", ".join([_round(0, "select idx // 100 as batch_id, idx % 100 as j, customer_id from numbered"), _round(1, _halved(0)), _round(2, _halved(1))])
_ATTEMPTS = " union all ".join(f"select distinct {i} as round, batch_id, n, case when {_FAILS} then 'failed' else 'ok' end as status from round{i}" for i in range(3))

ORACLES: dict[str, str] = {
    "scan_text_csv": _with("csv") + f"select {_ALL} from csv",
    "retry_rounds": _with("numbered", extra=_ROUNDS) + _ATTEMPTS,
    "scan_by_name": _with("mixed") + f"select {_MIXED} from mixed where fault is null or fault = 'short'",
    "scan_rejects": _with("mixed") + _REJECTED,
    "missing_markers": _with("marked") + f"select {_ALL} from marked",
    "numeric_coerce": _with("numbers") + "select * from numbers",
    "range_rules": _with("ranged") + "select customer_id, loan_amnt, fico_score, dti, annual_inc from ranged",
    "home_ownership": _with("homes") + "select * from homes",
    "grade_reference": _with("grades") + "select customer_id, first_letter as grade from grades",
    "grade_token": _with("grades") + "select customer_id, token as grade from grades",
    "phone_normalize": _with("phones") + "select * from phones",
    "purpose_match": _with("marked", extra=_MATCHED, recursive=True) + "select customer_id, purpose_original, purpose from purposes",
    "clean_layer1": _with(*_LAYER1_TABLES, extra=_MATCHED, recursive=True)
    + "select " + ", ".join(f"{v} as {c}" for c, v in _LAYER1_COLUMNS.items()) + " " + _LAYER1_FROM,
    "note_repair": _with("csv") + _notes(NOTE_WORDS),
    "null_delta": _with("marked", "phones", "ranged", extra=_MATCHED + """,
  joined as (select m.phone as phone_b, ph.phone as phone_a, m.purpose as purpose_b, pu.purpose as purpose_a, m.loan_amnt as loan_amnt_b,
    r.loan_amnt as loan_amnt_a, m.fico_score as fico_score_b, r.fico_score as fico_score_a, m.dti as dti_b, r.dti as dti_a,
    m.annual_inc as annual_inc_b, r.annual_inc as annual_inc_a
    from marked m join phones ph on m.customer_id = ph.customer_id join ranged r on m.customer_id = r.customer_id
    join purposes pu on m.customer_id = pu.customer_id)""", recursive=True)
    + " union all ".join(_delta(c, f"{c}_b", f"{c}_a") for c in ["phone", "purpose", "loan_amnt", "fico_score", "dti", "annual_inc"]),
    "unmapped_purpose": _with("marked", extra=_MATCHED, recursive=True)
    + "select purpose_original as value, count(*) as n from purposes where purpose is null and purpose_original is not null group by 1",
    "category_profile": _with("marked") + 'select * from (select "column", value, n, row_number() over (partition by "column" order by first_pos) as rank from ('
    + " union all ".join(f"select '{c}' as \"column\", {c} as value, count(*) as n, min(row_pos) as first_pos from marked group by {c}" for c in PROFILED_COLUMNS)
    + ") t) u where rank <= 15",
    "indel_ratio_values": _with("loans", "clean", extra="pairs_ab as (select distinct lower(l.purpose) as a, c.purpose as b from loans l join clean c on l.customer_id = c.customer_id), "
    + _LCS, recursive=True) + "select a, b, round(ratio, 6) as ratio from lcs",
    "jaro_winkler_values": _with("csv") + """select customer_id, round(coalesce(jaro_winkler_similarity(full_name, street_address), 0), 9) as name_address,
      round(coalesce(jaro_winkler_similarity(email, lower(full_name)), 0), 9) as mail_name from csv""",
    "date_candidates": _with("found") + "select customer_id, cast(len(fa) as bigint) as n, coalesce(list_aggregate(list_transform(fa, lambda d: cast(d as varchar)), 'string_agg', ','), '') as dates from found",
    "date_solver": _with("solved") + "select * from solved",
    "date_min_gap": _with("smallest_gap") + "select * from smallest_gap",
    "solver_outcomes": _with("fit_counts") + "select case when n = 1 then 'one' when n = 0 then 'none' else 'several' end as outcome, count(*) as n from fit_counts group by 1",
    "date_overlay": _with("overlaid") + "select * from overlaid",
    "date_rule_check": _with("gaps") + "select customer_id, application_date, issue_date, gap_days from gaps where gap_days not between 1 and 30",
    "date_rule_check_strict": _with("broken") + "select customer_id, application_date, issue_date, gap_days from broken",
    "block_pairs": _with("link") + """select a.last_name, a.zip_code, count(distinct a.id) as n_rows, count(b.id) as n_pairs
      from link a left join link b on a.last_name = b.last_name and a.zip_code = b.zip_code and a.pos > b.pos group by 1, 2""",
    "block_report": _with("crowded") + """select cast(floor(log2(n)) as bigint) as size_class, count(*) as n_blocks, cast(sum(n) as bigint) as n_rows,
      cast(sum(n * (n - 1) // 2) as bigint) as n_pairs, max(n) as largest from (select count(*) as n from crowded group by last_name, zip_code) sizes group by 1""",
    "crowded_pairs": _with("crowded_rows") + "select decision, round(total_score, 6) as total_score, count(*) as n_pairs from crowded_rows where decision <> 'auto_not' group by 1, 2",
    "pair_scores": _with("profile_pairs") + "select * from profile_pairs",
    "dup_triage": _with("row_pairs") + "select decision, count(*) as n_pairs from row_pairs group by 1",
    "gray_payload": _with("profile_pairs", "csv") + f"select p.id_a, p.id_b, cast({_pair_json('a')} as varchar) as record_a, cast({_pair_json('b')} as varchar) as record_b "
    "from profile_pairs p join csv a on p.id_a = a.customer_id join csv b on p.id_b = b.customer_id where p.decision = 'gray'",
    "duplicate_flags": _with("flags") + "select id as customer_id, duplicate_of from flags",
    "flags_from_pairs": _with("profile_pairs", "link") + "select id_a as customer_id, arg_max(id_b, l.pos) as duplicate_of from profile_pairs p join link l on p.id_b = l.id where decision = 'auto_dup' group by 1",
    "repeated_keys": _with("flags") + "select count(*) - count(distinct id) as repeated from flags",
    "verdict_flags": _with("row_pairs", "profile_pairs", extra="""found as (select id_a as id, arg_max(id_b, pos_b) as duplicate_of from row_pairs where decision = 'auto_dup' group by 1),
  verdicts as (select id_b as id, max(id_a) as duplicate_of from profile_pairs where decision = 'gray' and address_score < 1 group by 1),
  meant as (select id_a as id, arg_max(id_b, pos_b) as duplicate_of from row_pairs where decision = 'gray' and not same_address group by 1)""")
    + """select id as customer_id, coalesce(v.duplicate_of, m.duplicate_of, f.duplicate_of) as duplicate_of
      from found f full join meant m using (id) full join verdicts v using (id)""",
    "dup_quality": _with("row_pairs", "loans", extra="""known as (select customer_id as d, concat('LC', cast(100000 + k as varchar)) as o from loans where customer_id like 'DUP%'),
  taken as (select id_a, id_b from row_pairs where decision = 'auto_dup' or (decision = 'gray' and same_address)),
  nums as (select (select count(*) from known) as true_pairs,
    (select count(*) from known join taken on (d = id_a and o = id_b) or (d = id_b and o = id_a)) as true_found, (select count(*) from taken) as found)""")
    + "select *, round(true_found / found::double, 6) as precision, round(true_found / true_pairs::double, 6) as recall from nums",
    "final_merge": _with(*_LAYER1_TABLES, "overlaid", "flags", extra=_MATCHED, recursive=True)
    + "select " + ", ".join(f"{v} as {c}" for c, v in _FINAL_COLUMNS.items())
    + ", o.application_date, o.issue_date, o.advisor_notes, f.duplicate_of is not null as is_duplicate, f.duplicate_of "
    + _LAYER1_FROM + " left join overlaid o on m.customer_id = o.customer_id left join flags f on m.customer_id = f.id",
    "keyed_update": _with("min_gap_layer2") + "select * from min_gap_layer2",
    "pass2_upsert": _with("layer2", "min_gap_updates") + """select * from layer2 where customer_id not in (select customer_id from min_gap_updates)
      union all select u.customer_id, coalesce(u.application_date, l.application_date), coalesce(u.issue_date, l.issue_date), l.advisor_notes
      from min_gap_updates u join layer2 l on u.customer_id = l.customer_id""",
    "min_gap_accuracy": _with("min_gap_layer2", "truth") + _accuracy("min_gap_layer2"),
    "escalation_batches": _with("numbered", extra=_BATCHED) + "select batch_id, n, cast(request as varchar) as request from requests",
    "reply_parse": _with("numbered") + "select customer_id, application_date, issue_date, advisor_notes from numbered where (idx // 100) % 7 not in (3, 5)",
    "reply_incomplete": _with("numbered") + """select batch_id, n, case when batch_id % 7 = 3 then 'broken' else 'incomplete' end as status,
      case when batch_id % 7 = 5 then n - 1 end as got, false as ids_match
      from (select idx // 100 as batch_id, count(*) as n from numbered group by 1) b where batch_id % 7 in (3, 5)""",
    "verdict_parse": _with("cross_pairs", "profile_pairs") + """select id_a as record_a_id, id_b as record_b_id, address_score = 1 as is_duplicate from profile_pairs where decision = 'gray'""",
    "escalation_resolve": _with("csv", "layer2") + """select * from layer2 union all
      select customer_id, application_date, issue_date, trim(coalesce(advisor_notes, '')) as advisor_notes from csv
      where customer_id not in (select customer_id from layer2)""",
    "second_pass": _with("csv", "layer2", "broken") + """select * from layer2 where customer_id not in (select customer_id from broken) union all
      select customer_id, application_date, issue_date, trim(coalesce(advisor_notes, '')) as advisor_notes
      from csv where customer_id in (select customer_id from broken)""",
    "escalation_notes": _with("csv", "solved", extra=f"notes as ({_notes([*NOTE_WORDS, 'papers'])})") + """select c.customer_id,
        case when not s.is_ambiguous then s.solved_application_date else c.application_date end as application_date,
        case when not s.is_ambiguous then s.solved_issue_date else c.issue_date end as issue_date,
        case when s.is_ambiguous or n.needs_review then replace(trim(coalesce(c.advisor_notes, '')), 'pprs', 'papers') else n.advisor_notes end as advisor_notes
      from csv c join solved s on c.customer_id = s.customer_id join notes n on c.customer_id = n.customer_id""",
    "evaluate": _with("csv", "overlaid", "truth", "solved", "fit_counts", "row_pairs", "loans", extra=_FINAL_DATES + ", " + _ERR.replace("layer2", "dated") + """,
  known as (select customer_id as d, concat('LC', cast(100000 + k as varchar)) as o from loans where customer_id like 'DUP%'),
  taken as (select id_a, id_b from row_pairs where decision = 'auto_dup')""")
    + f"""select 'accuracy' as part, "column" as item, correct as value from ({_accuracy('dated')}) a
      union all select 'errors', case when coalesce(year(ag) = year(ta) and month(ag) = day(ta) and day(ag) = month(ta) and month(ag) <> day(ag), false)
        then 'day_month_swap' else 'other' end, count(*) from errors group by 2
      union all select 'outcomes', case when n = 1 then 'one' when n = 0 then 'none' else 'several' end, count(*) from fit_counts group by 2
      union all select 'solver', "column", correct from ({_accuracy('solved', 'solved_application_date', 'solved_issue_date', 'not x.is_ambiguous')}) s
      union all select 'duplicates', 'true_pairs', count(*) from known
      union all select 'duplicates', 'true_found', count(*) from known join taken on (d = id_a and o = id_b) or (d = id_b and o = id_a)
      union all select 'duplicates', 'found', count(*) from taken""",
    "resume_todo": _with("csv", "layer2") + "select customer_id, row_pos from csv where customer_id not in (select customer_id from layer2)",
    "resume_union": _with("csv", "layer2") + """select * from layer2 union all
      select customer_id, application_date, issue_date, advisor_notes from csv where customer_id not in (select customer_id from layer2)""",
    "recheck_queue": _with("csv", "broken") + "select customer_id, application_date, issue_date, advisor_notes from csv where customer_id in (select customer_id from broken)",
    "accuracy": _with("layer2", "truth") + _accuracy("layer2"),
    "solver_accuracy": _with("solved", "truth") + _accuracy("solved", "solved_application_date", "solved_issue_date", "not x.is_ambiguous"),
    "date_error_classes": _with("layer2", "truth", extra=_ERR) + """select case when coalesce(year(ag) = year(ta) and month(ag) = day(ta) and day(ag) = month(ta)
      and month(ag) <> day(ag), false) then 'day_month_swap' else 'other' end as error_class, count(*) as n from errors group by 1""",
    "date_error_sample": _with("layer2", "truth", extra=_ERR) + """select customer_id, application_date_got, application_date_truth, issue_date_got, issue_date_truth,
      ig - ag as gap_got, ti - ta as gap_truth from errors order by md5('1:' || customer_id), customer_id limit 15""",
    "saved_counts": _with("csv", "overlaid", "flags", "profile_pairs", "row_pairs") + _SAVED,
    "stage_metrics": _with("phones", "ranged", "solved", "csv", "overlaid", "flags") + _METRICS,
    "installment_values": _with("clean") + """select customer_id, round(a * (r * pow(1 + r, n)) / (pow(1 + r, n) - 1), 2) as installment
      from (select customer_id, cast(loan_amnt as double) as a, cast(int_rate as double) / 100 / 12 as r, cast(term_months as double) as n from clean) t""",
    "debt_to_income_values": _with("clean") + """select customer_id, round(least(greatest((p + m * (d / 300)) / m * 100, 0.0::double), 45.0::double), 2) as dti
      from (select customer_id, cast(installment as double) as p, cast(annual_inc as double) / 12 as m, cast(dti as double) as d from clean) t""",
    "gen_loans": _gen_loans(),
    "inject_missing": _with("clean") + f"""select customer_id, case when hit then {_one_of(["", "NULL", "N/A", "unknown", "-1"], _dirty_num("missing/annual_inc", 0))} else annual_inc end as annual_inc,
      case when hit then 1 else 0 end::bigint as changes from (select *, row_number() over (order by md5('7:missing/annual_inc/rows:' || customer_id)) <= floor(count(*) over () * 0.04::double) as hit from clean) t""",
    "inject_date_format": _with("clean") + f"select customer_id, {_messy_date('issue_date')} as issue_date from clean",
    "inject_decimal_comma": _with("clean") + f"select customer_id, case when {_dirty_uni('comma/int_rate/rows', 0)} < 0.08::double then replace(int_rate, '.', ',') else int_rate end as int_rate from clean",
    "inject_categories": _with("clean") + f"""select customer_id, {_variants('home_ownership', HOME_VARIANTS, 0.15)} as home_ownership,
      {_variants('purpose', PURPOSE_VARIANTS, 0.1)} as purpose,
      case when {_dirty_uni('variant/grade/rows', 0)} < 0.1::double then case {_dirty_num('variant/grade', 0)} % 4 when 0 then lower(grade) when 1 then ' ' || grade
        when 2 then grade || ' ' else 'grade ' || grade end else grade end as grade from clean""",
    "inject_text_noise": _with("clean") + _noise(),
    "inject_outliers": _with("clean") + "select customer_id, " + ", ".join([
        _outlier("loan_amnt", f"'-' || cast(1000 + {_dirty_num('outlier/loan_amnt', 0)} % 39000 as varchar)"),
        _outlier("fico_score", "'9999'"), _outlier("dti", f"cast(150 + {_dirty_num('outlier/dti', 0)} % 849 as varchar)")]) + " from clean",
    "inject_phone": _with("clean") + _phone(),
    "inject_duplicates": _with("clean", extra=f"""
      copies as (select 'DUP' || cast(999 + row_number() over (order by md5('7:duplicate/rows:' || customer_id)) as varchar) as customer_id,
        case when {_dirty_uni('duplicate', 0)} < 0.5::double then upper(full_name) else full_name end as full_name,
        case when {_dirty_uni('duplicate', 1)} < 0.3::double then replace(email, '@', '+dup@') else email end as email, customer_id as original_id
        from clean where {_dirty_uni('duplicate/rows', 0)} < 0.015::double),
      every as (select customer_id, full_name, email, null as original_id from clean union all select * from copies)""")
    + "select customer_id, full_name, email, row_number() over (order by md5('7:shuffle:' || customer_id)) - 1 as row_pos, original_id from every",
    "dirt_log": _dirt_log(),
    "round_trip_accuracy": _with("clean", extra=_MESSY) + _accuracy("messy_solved"),
}
ORACLES["whole_job"] = ORACLES["final_merge"]
