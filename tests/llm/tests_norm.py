"""Order-free comparison of two result frames."""

import pandas as pd


def norm(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    clean = lambda v: None if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)) else round(v, 9) if isinstance(v, float) else v
    return [tuple(df.columns), *sorted(tuple(str(clean(v)) for v in row) for row in df.itertuples(index=False, name=None))]
