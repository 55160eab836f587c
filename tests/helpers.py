import math


def norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def rows(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
