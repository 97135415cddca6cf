from tripmart.config import TESTDATA
from tripmart.operators import gold as G
from tripmart.plans.catalog import layers
from tripmart.schemas import SILVER_DDL, STAR_DDL, names_and_types, schema, star_schema

SF = "/root/testdata/sf0.001"


def test_built_star_matches_declared_schemas(spark):
    ly = layers(spark, SF, TESTDATA)
    assert names_and_types(ly.silver.schema) == names_and_types(schema(SILVER_DDL))
    built = {"fct_trips": ly.star.fct, "dim_date": ly.star.dim_date, "dim_zone": ly.star.dim_zone,
             "dim_service_type": ly.star.dim_service_type,
             "dim_payment_type": ly.star.dim_payment_type, "dim_vendor": ly.star.dim_vendor}
    for name, df in built.items():
        assert names_and_types(df.schema) == names_and_types(star_schema(name)), name


def test_written_star_reads_back_with_declared_schemas(spark, tmp_path):
    lazy = layers(spark, SF, TESTDATA).star
    star = G.write_star(spark, lazy, str(tmp_path / "star"))
    assert names_and_types(star.fct.schema) == names_and_types(star_schema("fct_trips"))
    assert star.fct.count() == lazy.fct.count()
    assert star.dim_date.count() == TESTDATA.calendar_days
