"""Business labels (L01-L12) and scores (X01-X11) as column expressions.

All thresholds, weights and label texts below are fixed values that must equal
the reference's models for the same results; they are kept verbatim.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import round_to

__all__ = [
    "rating_category", "tag_sentiment", "tag_category", "GENRE_FLAGS",
    "genre_quality_tier", "genre_popularity_tier", "movie_quality_tier",
    "movie_engagement_level", "user_profile", "user_engagement_level",
    "favorite_genre", "popularity_score", "genre_score", "recommendation_score",
    "text_matches_any", "tier",
]

# ---- fixed values -------------------------------------------------------------
# L01 rating_category: (lower bound, label), first match wins
RATING_CATEGORY = [(4.5, "Excelente"), (3.5, "Bom"), (2.5, "Regular")]
RATING_CATEGORY_ELSE = "Ruim"
# L02 sentiment: substrings of the lower-cased tag
POSITIVE_WORDS = ["love", "great", "best", "amazing", "excellent"]
NEGATIVE_WORDS = ["hate", "bad", "worst", "terrible", "awful"]
SENTIMENT_POSITIVE, SENTIMENT_NEGATIVE, SENTIMENT_NEUTRAL = "Positivo", "Negativo", "Neutro"
# L03 tag_category, first match wins
TAG_CATEGORIES = [
    (["funny", "comedy"], "Humor"),
    (["action", "fight"], "Ação"),
    (["romantic", "love"], "Romance"),
    (["scary", "horror"], "Terror"),
    (["twist", "plot"], "Enredo"),
]
TAG_CATEGORY_ELSE = "Outros"
# L04 genre flags: (column, substring of the genres text)
GENRE_FLAGS = [
    ("is_action", "Action"), ("is_comedy", "Comedy"), ("is_drama", "Drama"),
    ("is_thriller", "Thriller"), ("is_romance", "Romance"), ("is_horror", "Horror"),
    ("is_scifi", "Sci-Fi"), ("is_animation", "Animation"), ("is_documentary", "Documentary"),
]
# L06 / L07 genre tiers
GENRE_QUALITY = [(4.0, "Alta Qualidade"), (3.5, "Boa Qualidade"), (3.0, "Qualidade Média")]
GENRE_QUALITY_ELSE = "Baixa Qualidade"
GENRE_POPULARITY = [(50000, "Muito Popular"), (10000, "Popular"), (1000, "Moderado")]
GENRE_POPULARITY_ELSE = "Nicho"
# L08 movie quality tier: (min avg, min ratings or None, label); last rule is avg < 3.0
MOVIE_QUALITY = [(4.0, 100, "Blockbuster"), (3.5, 50, "Popular"), (3.0, None, "Mediano")]
MOVIE_UNPOPULAR = (3.0, 20, "Impopular")
MOVIE_QUALITY_ELSE = "Pouco Avaliado"
# L09 movie engagement
MOVIE_ENGAGEMENT = [(1000, "Alto"), (100, "Médio"), (10, "Baixo")]
MOVIE_ENGAGEMENT_ELSE = "Muito Baixo"
# L10 / L11 user labels
USER_PROFILE = [(4.0, "Otimista"), (3.0, "Equilibrado")]
USER_PROFILE_ELSE = "Crítico"
USER_ENGAGEMENT = [(1000, "Super Ativo"), (500, "Muito Ativo"), (100, "Ativo"), (20, "Moderado")]
USER_ENGAGEMENT_ELSE = "Casual"
# L12 favourite genre, in tie order; the last one is the fall-through
FAVORITE_GENRES = ["Action", "Comedy", "Drama", "Thriller", "Romance"]
# X01 / X02 / X03 weights and caps
POPULARITY_WEIGHTS = (0.4, 0.3, 0.3)
POPULARITY_CAPS = (10.0, 5.0)
GENRE_SCORE_WEIGHTS = (0.5, 0.3, 0.2)
GENRE_SCORE_CAPS = (15.0, 100.0, 1.0)
RECOMMENDATION_WEIGHTS = (0.6, 0.2, 0.2)
# -------------------------------------------------------------------------------


def tier(x: Column, bounds, otherwise: str) -> Column:
    """First ``x >= bound`` wins; null ``x`` falls through to ``otherwise``."""
    out = None
    for bound, label in bounds:
        cond = x >= F.lit(bound)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def text_matches_any(lowered: Column, words) -> Column:
    """``lower(tag) like '%w%' or ...``: plain substring tests."""
    cond = None
    for w in words:
        c = lowered.contains(w)
        cond = c if cond is None else (cond | c)
    return cond


def rating_category(rating: Column) -> Column:
    return tier(rating, RATING_CATEGORY, RATING_CATEGORY_ELSE)


def tag_sentiment(tag: Column) -> Column:
    low = F.lower(tag)
    return (F.when(text_matches_any(low, POSITIVE_WORDS), F.lit(SENTIMENT_POSITIVE))
            .when(text_matches_any(low, NEGATIVE_WORDS), F.lit(SENTIMENT_NEGATIVE))
            .otherwise(F.lit(SENTIMENT_NEUTRAL)))


def tag_category(tag: Column) -> Column:
    low = F.lower(tag)
    out = None
    for words, label in TAG_CATEGORIES:
        cond = text_matches_any(low, words)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(TAG_CATEGORY_ELSE))


def genre_quality_tier(avg_rating: Column) -> Column:
    return tier(avg_rating, GENRE_QUALITY, GENRE_QUALITY_ELSE)


def genre_popularity_tier(total_ratings: Column) -> Column:
    return tier(total_ratings, GENRE_POPULARITY, GENRE_POPULARITY_ELSE)


def movie_quality_tier(avg_rating: Column, total_ratings: Column) -> Column:
    out = None
    for min_avg, min_n, label in MOVIE_QUALITY:
        cond = avg_rating >= F.lit(min_avg)
        if min_n is not None:
            cond = cond & (total_ratings >= F.lit(min_n))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    below, min_n, label = MOVIE_UNPOPULAR
    out = out.when((avg_rating < F.lit(below)) & (total_ratings >= F.lit(min_n)), F.lit(label))
    return out.otherwise(F.lit(MOVIE_QUALITY_ELSE))


def movie_engagement_level(total_ratings: Column) -> Column:
    return tier(total_ratings, MOVIE_ENGAGEMENT, MOVIE_ENGAGEMENT_ELSE)


def user_profile(avg_rating: Column) -> Column:
    return tier(avg_rating, USER_PROFILE, USER_PROFILE_ELSE)


def user_engagement_level(total_ratings: Column) -> Column:
    return tier(total_ratings, USER_ENGAGEMENT, USER_ENGAGEMENT_ELSE)


def favorite_genre(counts: dict[str, Column]) -> Column:
    """Arg-max in tie order; each genre is compared with ``greatest`` of the later ones.

    ``greatest`` skips nulls, and a null comparison falls through, so a user with
    no matched movie gets the last genre.
    """
    names = FAVORITE_GENRES
    out = None
    for i, g in enumerate(names[:-1]):
        rest = [counts[n] for n in names[i + 1:]]
        other = rest[0] if len(rest) == 1 else F.greatest(*rest)
        cond = counts[g] >= other
        out = F.when(cond, F.lit(g)) if out is None else out.when(cond, F.lit(g))
    return out.otherwise(F.lit(names[-1]))


def popularity_score(avg_rating: Column, total_ratings: Column, total_tags: Column) -> Column:
    """X01 (operands in the reference's left-to-right order, double arithmetic)."""
    wa, wr, wt = POPULARITY_WEIGHTS
    cap_r, cap_t = POPULARITY_CAPS
    a = F.coalesce(avg_rating, F.lit(0.0)) * F.lit(wa)
    r = F.least(F.log10(F.coalesce(total_ratings, F.lit(1)).cast("double")), F.lit(cap_r)) * F.lit(wr)
    t = F.least(F.log10(F.coalesce(total_tags, F.lit(1)).cast("double")), F.lit(cap_t)) * F.lit(wt)
    return round_to(a + r + t, 2)


def genre_score(avg_rating: Column, total_ratings: Column, avg_ratings_per_movie: Column) -> Column:
    """X02; ``least`` skips nulls, as in the reference."""
    wa, wr, we = GENRE_SCORE_WEIGHTS
    cap_r, per, cap_e = GENRE_SCORE_CAPS
    a = avg_rating * F.lit(wa)
    r = F.least(F.log10(F.nullif(total_ratings, F.lit(0)).cast("double")), F.lit(cap_r)) * F.lit(wr)
    e = F.least(avg_ratings_per_movie / F.lit(per), F.lit(cap_e)) * F.lit(we)
    return round_to(a + r + e, 2)


def recommendation_score(jaccard: Column, year_diff: Column, avg_rating: Column) -> Column:
    """Unrounded Jaccard, a year term that is 0 when a year is missing, the partner's rating."""
    wj, wy, wr = RECOMMENDATION_WEIGHTS
    year_term = (F.lit(5.0) - F.least(year_diff.cast("double") / F.lit(10.0), F.lit(5.0))) / F.lit(5.0) * F.lit(wy)
    return round_to(jaccard * F.lit(wj) + year_term + avg_rating / F.lit(5.0) * F.lit(wr), 3)
