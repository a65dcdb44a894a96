"""Operations of training-data pipelines; nothing outside this subpackage imports it."""
