"""Texts that callers and their monitoring rely on."""

# The wording of errors and warnings.
COLUMN_NOT_FOUND = 'Column "{column}" specified for incremental fetching was not found in the table'
UNEXPECTED_TYPE = 'Column "{column}" specified for incremental fetching has unexpected type "{type}", expected: "{expected}".'
EMPTY_RESULT = 'Query result set is empty. Exported "0" rows to "{table}".'
