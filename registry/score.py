"""F: scaling and scoring."""

from __future__ import annotations

from registry.core import query, rounded
from registry.sql import NUMERIC, with_tables
from shelfrank.operators.score import NEWNESS_SCORE, fit_extents, fit_scaler, with_composite_score, with_min_max


@query(
    "f1_min_max",
    with_tables("SELECT row_id, round(discount_score, 6) AS discount_score, round(likes_score, 6) AS likes_score FROM scored"),
)
def scaled(t):
    names = {"discount": "discount_score", "likes_count": "likes_score"}
    df = with_min_max(t.cleaned, fit_extents(t.cleaned, list(names)), names)
    return rounded(df.select("row_id", *names.values()), *names.values())


@query("f2_inverse_min_max", with_tables("SELECT row_id, round(price_score, 6) AS price_score FROM scored"))
def inverse(t):
    names = {"current_price": "price_score"}
    df = with_min_max(t.cleaned, fit_extents(t.cleaned, list(names)), names, inverse=list(names))
    return rounded(df.select("row_id", "price_score"), "price_score")


@query(
    "f3_z_score",
    with_tables("SELECT row_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in NUMERIC) + " FROM zscored"),
)
def standardised(t):
    df = fit_scaler(t.cleaned, NUMERIC).transform(t.cleaned)
    return rounded(df.select("row_id", *NUMERIC), *NUMERIC)


@query(
    "f4_newness_score",
    with_tables(
        """SELECT row_id, new_score, round(0.40::DOUBLE * likes_score + 0.30::DOUBLE * discount_score
        + 0.20::DOUBLE * price_score + 0.10::DOUBLE * new_score, 6) AS composite_score
        FROM (SELECT *, CASE WHEN is_new THEN 1 ELSE 0 END AS new_score FROM scored)"""
    ),
)
def newness_score(t):
    df = with_composite_score(t.cleaned, NEWNESS_SCORE)
    return rounded(df.select("row_id", "new_score", "composite_score"), "composite_score")


@query("f5_ranking_score", with_tables("SELECT row_id, round(composite_score, 6) AS composite_score FROM scored"))
def ranking_score(t):
    return rounded(t.scored.select("row_id", "composite_score"), "composite_score")
