import re

SF_SMALL = "/root/testdata/sf0.001"


def no_python(plan: str) -> bool:
    return not re.search(r"Python|Pandas|Arrow(?!ed)|MapIn", plan)
