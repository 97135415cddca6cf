"""DataFrame -> DataFrame operators of the warehouse layers: bronze, silver,
gold (star schema), joins with size-checked broadcasts, exact percentiles,
data-quality checks and median imputation."""
