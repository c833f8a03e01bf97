"""Operations on training corpora: quality, copies, licences, archives, tokens and private data.

Nothing else in the library imports this package.
"""
