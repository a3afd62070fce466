from conftest_llm import awkward  # noqa: F401
