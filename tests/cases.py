"""Where cases over declared rows are kept: functions (spark, sf_dir) with their SQL, run by test_cases."""

CASES, SQL = {}, {}


def case(sql=None):
    def add(f):
        CASES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
