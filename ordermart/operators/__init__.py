from . import clean, features, kpis, preagg, quality, ranking, segments, wide  # noqa: F401
