"""Operations of a training-data pipeline on text and vector tables.

Nothing outside this package imports it; ``queries.py`` registers its queries.
"""
