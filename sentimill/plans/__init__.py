"""Plan building blocks that keep hot keys and long orderings spread over many tasks."""
