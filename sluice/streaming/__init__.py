"""Extensions: the batch operators on streams."""
