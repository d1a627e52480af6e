"""The queries over training data and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from noticeloom.llm.boilerplate import p5_found
from noticeloom.llm.canonical import p6_found
from noticeloom.llm.history import p1_found
from noticeloom.llm.match import p4_found, p4_matches
from noticeloom.llm.mix import p8_selection, p8_shares
from noticeloom.llm.near import p3_found
from noticeloom.llm.pack import p7_containers
from noticeloom.llm.split import p9_found, p9_pieces

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_matches": p4_matches,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_containers": p7_containers,
    "p8_selection": p8_selection,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_pieces": p9_pieces,
}
ORACLE: dict[str, str] = {
    # every pair of rows with a common word, counted
    "p3_found": """with t as (select edital_id, list_distinct(regexp_extract_all(strip_accents(translate(lower(coalesce(nome, '') || ' ' || "descrição"), 'ºª²³¹ ', 'oa231 ')), '[a-z0-9]+')) as w from edital where trim("descrição") <> ''),
  u as (select edital_id, len(w) as n, unnest(w) as word from t),
  p as (select a.edital_id as x, b.edital_id as y, count(*) as k, any_value(a.n) as na, any_value(b.n) as nb from u a join u b on a.word = b.word and a.edital_id < b.edital_id group by 1, 2)
  select x as edital_id_a, y as edital_id_b from p where k >= 0.7 * (na + nb - k)""",
}
