"""tessera: building and curating conversation datasets on Spark."""
